"""Running a load to exhaustion, so that a broken run goes on where it stopped."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreflow.plans.schemas import CURATED
from acreflow.sources.load import new_run


@dataclass(frozen=True)
class Source:
    source_id: str
    kind: str
    load: Callable[[SparkSession, str], tuple[DataFrame, DataFrame]]  # (spark, run_id) -> (good, bad)
    limitation: str | None = None


def log_run(spark: SparkSession, folder: str, rows: list[tuple]) -> None:
    """Appends to the run log."""
    spark.createDataFrame(rows, CURATED["run_log"]).coalesce(1).write.mode("append").parquet(f"{folder}/run_log")


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.parquet(f"{folder}/run_log")
    except Exception as e:  # nothing was logged yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], CURATED["run_log"])


def run(spark: SparkSession, sources: list[Source], folder: str, run_id: str | None = None) -> str:
    """Loads every source that this run has not finished yet; each writes its own folder, overwriting a broken try.

    A source that fails is logged with its error and the others go on; call again with the id to retry it.
    """
    run_id = run_id or new_run()
    done = {r[0] for r in read_log(spark, folder).filter((F.col("run_id") == run_id) & (F.col("status") == "done")).select("source_id").collect()}
    now = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    for s in sources:
        if s.source_id in done:
            continue
        began = now()
        try:
            good, bad = s.load(spark, run_id)
            good.write.mode("overwrite").parquet(f"{folder}/{s.kind}/run={run_id}/source={s.source_id}")
            bad.write.mode("overwrite").parquet(f"{folder}/_rejected/{s.kind}/run={run_id}/source={s.source_id}")
            counts = [spark.read.schema(x.schema).parquet(f"{folder}/{p}/run={run_id}/source={s.source_id}").count() for x, p in ((good, s.kind), (bad, f"_rejected/{s.kind}"))]
            log_run(spark, folder, [(run_id, s.source_id, s.kind, "done", began, now(), *counts, s.limitation)])
        except Exception as e:
            log_run(spark, folder, [(run_id, s.source_id, s.kind, "failed", began, now(), 0, 1, f"{type(e).__name__}: {str(e)[:300]}")])
    return run_id
