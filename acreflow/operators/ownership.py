"""Tenure, turnover, owners as of a date, and where owners are."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreflow.functions.columns import years_before


def last_transfers(transfers: DataFrame) -> DataFrame:
    """property_id, last_transfer, n_transfers of properties with a dated transfer."""
    return transfers.filter("transfer_date is not null").groupBy("property_id").agg(F.max("transfer_date").alias("last_transfer"), F.count(F.lit(1)).alias("n_transfers"))


def tenure_over(properties: DataFrame, transfers: DataFrame, as_of: dt.date, years: int, inclusive: bool = False) -> DataFrame:
    """Properties whose last transfer is more than ``years`` before ``as_of`` (or exactly, if inclusive).

    The limit is a literal on the aggregated date.  Properties without a transfer are unknown and not here;
    ``no_transfer_since`` has them.
    """
    limit = F.lit(years_before(as_of, years))
    last = last_transfers(transfers)
    return properties.join(last.filter(F.col("last_transfer") <= limit if inclusive else F.col("last_transfer") < limit), "property_id")


def no_transfer_since(properties: DataFrame, transfers: DataFrame, since: dt.date) -> DataFrame:
    """Properties with no recorded transfer on or after ``since``; those with none at all included."""
    return properties.join(transfers.filter(F.col("transfer_date") >= F.lit(since)).select("property_id"), "property_id", "left_anti")


def owner_as_of(transfers: DataFrame, when: dt.date) -> DataFrame:
    """The latest transfer of each property on or before ``when``; of one day the largest id."""
    w = Window.partitionBy("property_id").orderBy(F.desc("transfer_date"), F.desc("transfer_id"))
    return transfers.filter(F.col("transfer_date") <= F.lit(when)).withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def current_owner(transfers: DataFrame) -> DataFrame:
    """The latest dated transfer of each property; planned with a limit per group before the shuffle."""
    w = Window.partitionBy("property_id").orderBy(F.desc("transfer_date"), F.desc("transfer_id"))
    return transfers.filter("transfer_date is not null").withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def as_of_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str, bucket: Column | None = None) -> DataFrame:
    """``left`` with ``value`` of the latest ``right`` row of its key at or before its time; null if there is none.

    One shuffle by (key, bucket) instead of an inequality join: right rows and left rows are one ordered
    stream.  ``bucket`` (of the column ``t``, the month by default) cuts a hot key's stream; what was last
    before a bucket comes from an aggregate of one row for each key and bucket.  Of right rows with one time
    the largest value counts.  Left rows with a null key or time have no match.
    """
    bucket = F.date_trunc("month", F.col("t")) if bucket is None else bucket
    names = left.columns
    a = left.select(F.col(key).alias("k"), F.col(left_time).cast("timestamp_ntz").alias("t"), F.lit(1).alias("side"), F.struct(*names).alias("row"), F.lit(None).cast(right.schema[value].dataType).alias("v"))
    b = right.select(F.col(key).alias("k"), F.col(right_time).cast("timestamp_ntz").alias("t"), F.lit(0).alias("side"), F.lit(None).cast(left.select(F.struct(*names).alias("r")).schema["r"].dataType).alias("row"), F.col(value).alias("v")).filter("k is not null and t is not null and v is not null")
    ends = b.withColumn("b", bucket).groupBy("k", "b").agg(F.max(F.struct("t", "v")).alias("e"))
    over = Window.partitionBy("k").orderBy("b")
    spans = ends.select("k", "b", F.lead("b").over(over).alias("until"), F.col("e.v").alias("carry"))
    stream = a.unionByName(b).withColumn("b", bucket)
    w = Window.partitionBy("k", "b").orderBy("t", "side", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = stream.withColumn("in", F.last("v", ignorenulls=True).over(w)).filter("side = 1").select("k", "b", "row", "in")
    # What no row of its own bucket answers looks further back: the latest earlier bucket of its key.
    late = inside.filter("in is null").select("k", "b").distinct()
    marks = late.withColumn("carry", F.lit(None).cast(right.schema[value].dataType)).withColumn("o", F.lit(0)).unionByName(spans.select("k", "b", "carry", F.lit(1).alias("o")))
    back = Window.partitionBy("k").orderBy("b", "o").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("c", F.last("carry", ignorenulls=True).over(back)).filter("o = 0").select("k", "b", "c")
    out = inside.join(carried, ["k", "b"], "left")
    return out.select("row.*", F.coalesce("in", "c").alias(value))


def holding_periods(transfers: DataFrame, as_of: dt.date) -> DataFrame:
    """Each dated transfer with the next one of its property and the days between (to ``as_of`` for the last)."""
    w = Window.partitionBy("property_id").orderBy("transfer_date", "transfer_id")
    out = transfers.filter("transfer_date is not null").withColumn("next_date", F.lead("transfer_date").over(w))
    return out.select("property_id", "transfer_id", "transfer_date", "next_date", F.datediff(F.coalesce("next_date", F.lit(as_of)), "transfer_date").alias("days_held"))


def ownership_stability(transfers: DataFrame, as_of: dt.date) -> DataFrame:
    """property_id, n_transfers, last_transfer, tenure_days, mean_days_held."""
    held = holding_periods(transfers, as_of)
    out = held.groupBy("property_id").agg(F.count(F.lit(1)).alias("n_transfers"), F.max("transfer_date").alias("last_transfer"), F.sum("days_held").alias("__days"))
    return out.select("property_id", "n_transfers", "last_transfer", F.datediff(F.lit(as_of), "last_transfer").alias("tenure_days"), (F.col("__days").cast("double") / F.col("n_transfers")).alias("mean_days_held"))


def owner_area(df: DataFrame, mail: dict[str, str], situs: dict[str, str]) -> DataFrame:
    """Adds owner_area: local (same zip or city), regional (same state), out_of_area, or unknown.

    ``mail`` and ``situs`` name the columns for zip, city and state; states are needed, the others may be null.
    """
    same = lambda x: F.coalesce(F.upper(F.trim(mail[x])) == F.upper(F.trim(situs[x])), F.lit(False)) if x in mail and x in situs else F.lit(False)
    known = F.col(mail["state"]).isNotNull() & F.col(situs["state"]).isNotNull()
    area = F.when(~known & ~same("zip"), "unknown").when(same("zip") | (same("city") & same("state")), "local").when(same("state"), "regional").otherwise("out_of_area")
    return df.withColumn("owner_area", area)


def history(transfers: DataFrame) -> DataFrame:
    """property_id, ownership_history: all dated transfers in order, as an array of structs."""
    fields = [c for c in ("transfer_date", "transfer_id", "grantor_id", "grantee_id", "price", "prov") if c in transfers.columns]
    return transfers.filter("transfer_date is not null").groupBy("property_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("ownership_history"))
