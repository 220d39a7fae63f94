"""What was loaded, when, from where, how fast, and what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def totals_by_source(df: DataFrame, *by: str, collected_at: str = "prov.collected_at") -> DataFrame:
    """Rows by source (and more), with the first and last time they were collected."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.min(collected_at).alias("first_collected"), F.max(collected_at).alias("last_collected"))


def run_summary(log: DataFrame, *by: str) -> DataFrame:
    """For each source of a run its stages, rows, errors, time span, p95 of stage seconds and limitations."""
    seconds = F.col("ended_at").cast("timestamp").cast("double") - F.col("started_at").cast("timestamp").cast("double")
    return log.withColumn("__s", seconds).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_stages"), F.sum("n_rows").alias("n_rows"), F.sum("n_errors").alias("n_errors"),
        F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY __s)").alias("p95_seconds"),
        F.sort_array(F.collect_set("limitation")).alias("limitations"),
    )


def slow_sources(log: DataFrame, source: str, seconds: str, failed: str, k: int) -> DataFrame:
    """The ``k`` slowest sources by the 95th percentile, with their error rate: a bounded report."""
    out = log.groupBy(source).agg(F.count(F.lit(1)).alias("n_stages"), F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY {seconds})").alias("p95_seconds"), F.sum(F.expr(f"CASE WHEN {failed} THEN 1 ELSE 0 END")).alias("n_failed"))
    return out.orderBy(F.desc("p95_seconds"), source).limit(k)


def coverage(df: DataFrame, by: str, *columns: str) -> DataFrame:
    """Rows, and nulls in each column, by source."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns))
