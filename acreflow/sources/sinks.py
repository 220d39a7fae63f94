"""Publishing curated tables as plain Parquet, and the manifest of what was published."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from acreflow.plans import commits
from acreflow.sources.artifacts import CHUNK_BYTES, FAN, blocks

#: The file that names the snapshot to read.
POINTER = "current.json"


def publish(df: DataFrame, folder: str, name: str, key: str, rows_per_file: int = 5_000_000) -> str:
    """Writes ``df`` sorted by its key within files, for any Parquet reader; the path."""
    path = f"{folder}/{name}"
    df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path)
    return path


def publish_snapshot(df: DataFrame, folder: str, name: str, key: str, rows_per_file: int = 5_000_000) -> str:
    """Publishes ``df`` as a new snapshot beside the old ones, then swaps the pointer to it as the last step; the snapshot's path.

    Whatever fails before leaves the old snapshot in place, whole; readers that have begun on it go on.  Any Parquet
    reader can take the pointer's text as the folder to read.
    """
    spark, snapshot = df.sparkSession, f"snapshot-{uuid.uuid4().hex}"
    path = publish(df, f"{folder}/{name}", snapshot, key, rows_per_file)
    commits.swap(spark, f"{folder}/{name}/{POINTER}", json.dumps({"snapshot": snapshot, "schema": df.schema.jsonValue()}))
    return path


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table as it was published last; ``FileNotFoundError`` if it never was."""
    said = commits.current(spark, f"{folder}/{name}/{POINTER}")
    if said is None:
        raise FileNotFoundError(f"{name} was not published below {folder}")
    pointer = json.loads(said)
    return spark.read.schema(StructType.fromJson(pointer["schema"])).parquet(f"{folder}/{name}/{pointer['snapshot']}")


def retire(spark: SparkSession, folder: str, name: str) -> int:
    """Deletes the snapshots that the pointer does not name, broken ones among them, once nobody reads them; how many."""
    pointer = json.loads(commits.current(spark, f"{folder}/{name}/{POINTER}") or '{"snapshot": null}')
    old = [s for s in commits.folders(spark, f"{folder}/{name}") if s.startswith("snapshot-") and s != pointer["snapshot"]]
    for s in old:
        commits.remove(spark, f"{folder}/{name}/{s}")
    return len(old)


def manifest(spark: SparkSession, folder: str, dataset: str, run_id: str, chunk: int = CHUNK_BYTES, fan: int = FAN) -> DataFrame:
    """dataset, path, n_bytes, sha256, cid, n_blocks, single_block, run_id for each Parquet file under ``folder``.

    The identifier is that of the file's root, a raw block where the file is a single chunk; files are streamed.
    """
    files = blocks(spark, folder, chunk, fan, "*.parquet")[1]
    return files.select(F.lit(dataset).alias("dataset"), "path", "n_bytes", "sha256", "cid", "n_blocks", (F.col("n_blocks") == 1).alias("single_block"), F.lit(run_id).alias("run_id"))


def eligible(artifacts: DataFrame, public: list[str]) -> DataFrame:
    """Artifacts of public datasets that are not empty."""
    return artifacts.filter(F.col("dataset").isin(public) & (F.col("n_bytes") > 0))


def with_rows(artifacts: DataFrame, counts: DataFrame) -> DataFrame:
    """Artifacts with the number of rows of their dataset and run."""
    return artifacts.join(counts, ["dataset", "run_id"], "left")
