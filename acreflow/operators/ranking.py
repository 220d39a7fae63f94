"""Positions in a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreflow.plans.storage import stored


def positions(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """``df`` with its 1-based position by ``order``, which must be total.

    Rows are dealt into sorted ranges, numbered within them, and shifted by how many rows lie in the ranges
    before: one row a range, so the only global window is over as many rows as there are partitions.
    """
    dealt = stored(df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    numbered = dealt.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(*order)))
    return numbered.join(before, "__p").withColumn(name, F.col("__i") + F.col("__before")).drop("__p", "__i", "__before")


def percent_ranks(df: DataFrame, value: str, name: str = "percent_rank") -> DataFrame:
    """``df`` with (rank - 1) / (rows - 1) of ``value`` ascending, ties alike; null for null values, which do not count."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("__c"))
    dealt = stored(counts.repartitionByRange(F.col(value)).withColumn("__p", F.spark_partition_id()), "values")
    sums = dealt.groupBy("__p").agg(F.sum("__c").alias("__s"))
    w = Window.orderBy("__p")
    before = sums.select("__p", F.coalesce(F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"), F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__t"))
    inside = F.coalesce(F.sum("__c").over(Window.partitionBy("__p").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    less = dealt.withColumn("__l", inside).join(before, "__p")
    share = F.when(F.col("__t") > 1, (F.col("__l") + F.col("__b")).cast("double") / (F.col("__t") - 1)).otherwise(F.lit(0.0))
    return df.join(less.select(value, share.alias(name)), value, "left")


def tiles(df: DataFrame, n: int, *order: Column, name: str = "tile") -> DataFrame:
    """``df`` with its tile 1..n of about equal size by ``order`` (total), the larger ones first."""
    numbered = stored(positions(df, *order, name="__at"), "numbered")
    small, large = divmod(numbered.count(), n)
    at = F.col("__at") - 1
    tile = F.when(at < large * (small + 1), F.floor(at / (small + 1))).otherwise(large + F.floor((at - large * (small + 1)) / max(small, 1))) + 1
    return numbered.withColumn(name, tile.cast("int")).drop("__at")
