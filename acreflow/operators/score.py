"""Ranking candidates on what is known, and saying what is not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreflow.functions.columns import compact


def weighted_score(components: dict[str, Column], weights: dict[str, float]) -> Column:
    """The weighted mean of the components that are known; null if none is."""
    total = lambda f: sum((f(n, c) for n, c in components.items()), F.lit(0.0))
    top = total(lambda n, c: F.coalesce(c * F.lit(weights.get(n, 1.0)), F.lit(0.0)))
    weight = total(lambda n, c: F.when(c.isNotNull(), F.lit(weights.get(n, 1.0))).otherwise(F.lit(0.0)))
    return F.try_divide(top, weight)


def missing(components: dict[str, Column]) -> Column:
    """The names of the components that are not known."""
    return compact(*(F.when(c.isNull(), F.lit(n)) for n, c in components.items()))


def ranked(df: DataFrame, key: str, components: dict[str, Column], weights: dict[str, float], assumptions: Column | None = None) -> DataFrame:
    """``df`` with score, missing, assumptions.  Order it with ``top`` or page through it with ``page_after``."""
    out = df.withColumn("score", weighted_score(components, weights)).withColumn("missing", missing(components))
    return out.withColumn("assumptions", assumptions if assumptions is not None else F.array().cast("array<string>"))


def top(df: DataFrame, key: str, k: int) -> DataFrame:
    """The best ``k`` by (score descending, key), with their rank: a bounded report."""
    best = df.orderBy(F.desc_nulls_last("score"), key).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("score"), key)))


def page_after(df: DataFrame, key: str, k: int, last: tuple[float | None, int] | None = None) -> DataFrame:
    """The next ``k`` rows after ``last`` (score, key), by keyset, so a later page costs what the first does."""
    if last is not None:
        score, at = last
        later = F.col("score").isNull() & (F.col(key) > at) if score is None else (F.col("score") < score) | ((F.col("score") == score) & (F.col(key) > at)) | F.col("score").isNull()
        df = df.filter(later)
    return df.orderBy(F.desc_nulls_last("score"), key).limit(k)


def bucket_rank(value: Column, low: float, high: float, better: str = "high") -> Column:
    """A score in [0, 1] between two bounds: needs no global order, unlike percent_rank."""
    x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - F.lit(low)) / F.lit(high - low)))
    return F.when(value.isNotNull(), x if better == "high" else 1 - x)


def with_evidence(df: DataFrame, items: dict[str, Column]) -> DataFrame:
    """Adds evidence: JSON of the named values."""
    return df.withColumn("evidence", F.to_json(F.struct(*(c.alias(n) for n, c in items.items()))))
