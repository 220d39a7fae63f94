"""Exact percentiles of groups of any size by narrowing down.

A pass counts the values of each group in bins between its bounds and keeps the bin that holds the rank that is asked for; its
least and greatest value are the next bounds.  What travels is a count for each group and bin, never a group's values.  A
group is done when its bin holds one value, or few enough values to be numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreflow.plans.storage import stored

BINS = 1024
#: Values of a bin that are numbered at last.
FEW = 10_000
#: A double's bounds meet in fewer passes than this: bins are even in the values and in their logarithms by turns.
MAX_PASSES = 200


def _logarithm(v: Column) -> Column:
    """An order-keeping image of finite values with even steps for equal ratios; logarithms of doubles lie above -746."""
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.ln(F.abs(v)) + 760))


def percentiles(df: DataFrame, by: str, value: str, shares: tuple[float, ...], bins: int = BINS, few: int = FEW) -> DataFrame:
    """(by, share, value): for each group and share the least value that at least this share of the group's values does not exceed.

    Null values do not count; a group without any is not in the result.  Not a number counts as the greatest.  A null group is one.
    """
    rows = df.select(F.col(by).alias("g"), F.col(value).cast("double").alias("v")).filter("v is not null")
    asked = F.explode(F.array(*(F.lit(str(s)).cast("decimal(12,9)") for s in shares))).alias("share")
    finite = F.when(~F.isnan("v") & (F.abs("v") != float("inf")), F.col("v"))
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min(finite).alias("low"), F.max(finite).alias("high"), F.max("v").alias("most"), F.min("v").alias("least")).select("*", asked)
    rank = F.greatest(F.ceil(F.col("share") * F.col("n")), F.lit(1)).cast("long").alias("rank")
    state = stored(sizes.select("g", "share", rank, "n", "low", "high", "least", "most"), "ranks")
    out = None
    for k in range(MAX_PASSES):
        # Bounds met, or few values left in them: the rank is found by numbering these.
        done = state.filter((F.col("least") == F.col("most")) | (F.col("n") <= few))
        ready = stored(done.select("g", "share", "rank", "least", "most"), "ready")
        one = ready.filter("least = most").select("g", "share", F.col("least").alias("v"))
        inside = rows.alias("r").join(ready.filter("least <> most").alias("s"), F.col("r.g").eqNullSafe(F.col("s.g")) & F.col("v").between(F.col("least"), F.col("most")))
        numbered = inside.select(F.col("s.g").alias("g"), "share", "rank", "v").withColumn("at", F.row_number().over(Window.partitionBy("g", "share").orderBy("v")))
        found = one.unionByName(numbered.filter("at = rank").select("g", "share", "v"))
        out = found if out is None else out.unionByName(found)
        todo = state.filter((F.col("least") < F.col("most")) & (F.col("n") > few))
        if todo.isEmpty():
            return out.select(F.col("g").alias(by), F.col("share").cast("double").alias("share"), F.col("v").alias(value))
        met = rows.alias("r").join(todo.alias("s"), F.col("r.g").eqNullSafe(F.col("s.g")) & F.col("v").between(F.col("least"), F.col("most")))
        scale = _logarithm if k % 2 else lambda v: v / 2  # half the bounds, so that their difference is finite
        low, high = scale(F.col("low")), scale(F.col("high"))
        wide = F.when(high > low, (scale(F.col("v")) - low) / (high - low)).otherwise(0.0)
        bin_ = F.when(F.isnan("v"), bins + 1).when(F.col("v") == float("inf"), bins).when(F.col("v") == float("-inf"), -1).when(F.col("high") > F.col("low"), F.least(F.floor(wide * bins), F.lit(bins - 1))).otherwise(0)
        counted = met.select(F.col("s.g").alias("g"), "share", "rank", "v", bin_.cast("int").alias("bin")).groupBy("g", "share", "rank", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        before = F.sum("n").over(Window.partitionBy("g", "share").orderBy("bin")) - F.col("n")
        kept = counted.withColumn("before", before).filter((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n")))
        state = stored(kept.select("g", "share", (F.col("rank") - F.col("before")).alias("rank"), "n", F.col("least").alias("low"), F.col("most").alias("high"), "least", "most"), "ranks")
    raise RuntimeError(f"bounds have not met after {MAX_PASSES} passes")
