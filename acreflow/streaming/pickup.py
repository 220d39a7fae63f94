"""Incremental pickup of new files: a stream that takes what is there and stops."""

from __future__ import annotations

from pyspark.sql import SparkSession


def pick_up(spark: SparkSession, schema: str, source: str, target: str, checkpoint: str, fmt: str = "parquet") -> int:
    """Appends the rows of files under ``source`` that no earlier call with this ``checkpoint`` has taken to
    ``target``; how many.  Each file is taken once, across failures and restarts."""
    stream = spark.readStream.format(fmt).schema(schema).load(source)
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()
    return sum(int(p["numInputRows"]) for p in query.recentProgress)
