"""What permits and zoning say: roofs, industrial use, contractors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreflow.functions.columns import compact, years_before


def roof_age(properties: DataFrame, permits: DataFrame, as_of: dt.date, years: int, is_roofing: Column) -> DataFrame:
    """properties with roof_date, roof_source and old_roof, which is null where nothing is known.

    The roof is as old as the last roofing permit, else as the building (an assumption that roof_source names).
    """
    last = permits.filter(is_roofing & F.col("issued_date").isNotNull()).groupBy("property_id").agg(F.max("issued_date").alias("__permit"))
    out = properties.join(last, "property_id", "left")
    built = F.make_date("year_built", F.lit(1), F.lit(1)) if "year_built" in properties.columns else F.lit(None).cast("date")
    out = out.withColumn("roof_date", F.coalesce("__permit", built))
    source = F.when(F.col("__permit").isNotNull(), "permit").when(F.col("roof_date").isNotNull(), "year_built (assumed)")
    return out.withColumn("roof_source", source).withColumn("old_roof", F.col("roof_date") < F.lit(years_before(as_of, years))).drop("__permit")


def signal_counts(permits: DataFrame, is_signal: Column) -> DataFrame:
    """property_id, n_signals, last_signal of permits that point to industrial use."""
    return permits.filter(is_signal).groupBy("property_id").agg(F.count(F.lit(1)).alias("n_signals"), F.max("issued_date").alias("last_signal"))


def industrial_signal(properties: DataFrame, permits: DataFrame, is_signal: Column, zones: tuple[str, ...], least: int = 1) -> DataFrame:
    """properties with n_signals, last_signal, industrial (null if neither zoning nor permits are known) and basis."""
    out = properties.join(signal_counts(permits, is_signal), "property_id", "left")
    by_permit = F.coalesce(F.col("n_signals") >= least, F.lit(False))
    by_zone = F.upper("zoning").isin(*[z.upper() for z in zones]) if zones else F.lit(False)
    basis = compact(F.when(by_permit, F.concat(F.lit("permits: "), F.col("n_signals"))), F.when(by_zone, F.concat(F.lit("zoning: "), F.col("zoning"))))
    known = F.col("zoning").isNotNull() | F.col("n_signals").isNotNull()
    return out.withColumn("basis", basis).withColumn("industrial", F.when(known, F.size("basis") > 0)).withColumn("n_signals", F.coalesce("n_signals", F.lit(0)))


def with_contractors(permits: DataFrame, contractors: DataFrame) -> DataFrame:
    """permits with contractor_name; permits without a known contractor stay.  Spark broadcasts by measured size."""
    names = contractors.select("contractor_id", F.col("name").alias("contractor_name"))
    return permits.join(names, "contractor_id", "left")
