"""Joins through resolved entities and the zoning table, and signals that combine several sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreflow.functions.columns import valid_point
from acreflow.operators import permits as permit_operators
from acreflow.operators import proximity


def entity_map(df: DataFrame, kind: str, key: str, name: Column) -> DataFrame:
    """entity_kind, record_key, canonical_id, match_rule, score: records of one normal name are one entity, whatever
    their kind; a record without a name is an entity of its own."""
    named = df.select(F.lit(kind).alias("entity_kind"), F.col(key).cast("string").alias("record_key"), F.nullif(name, F.lit("")).alias("n"))
    alone = F.concat_ws(":", "entity_kind", "record_key")
    canonical = F.sha2(F.coalesce(F.concat(F.lit("name:"), "n"), alone), 256)
    return named.select("entity_kind", "record_key", canonical.alias("canonical_id"), F.when(F.col("n").isNotNull(), "name").otherwise("self").alias("match_rule"), F.lit(1.0).alias("score"))


def owner_businesses(owners: DataFrame, businesses: DataFrame, entities: DataFrame) -> DataFrame:
    """``owners`` with business_id and business_name of each business that is the same entity; owners without one stay."""
    of = lambda kind, key: entities.filter(F.col("entity_kind") == kind).select(F.col("record_key").alias(key), "canonical_id").distinct()
    own = owners.withColumn("__owner", F.col("owner_id").cast("string")).join(of("owner", "__owner"), "__owner", "left").drop("__owner")
    firms = businesses.select(F.col("business_id").cast("string").alias("__business"), "business_id", F.col("name").alias("business_name")).join(of("business", "__business"), "__business").drop("__business")
    return own.join(firms, "canonical_id", "left").drop("canonical_id")


def with_zoning(properties: DataFrame, zoning: DataFrame) -> DataFrame:
    """``properties`` with zoning_code, land_use_code and zoned_on of their latest zoning row; rows that only link to a
    source say nothing.  Of one date the largest codes count."""
    rows = zoning.filter(~F.coalesce("link_only", F.lit(False))) if "link_only" in zoning.columns else zoning
    last = rows.groupBy("property_id").agg(F.max(F.struct("effective_date", "zoning_code", "land_use_code")).alias("__z"))
    out = properties.join(last, "property_id", "left")
    return out.withColumns({"zoning_code": F.col("__z.zoning_code"), "land_use_code": F.col("__z.land_use_code"), "zoned_on": F.col("__z.effective_date")}).drop("__z")


def water_view(properties: DataFrame, waters: DataFrame, metres: float, max_lat: float = 60.0, flag: str | None = None) -> DataFrame:
    """Adds water_view and its basis: the source's own flag where there is one, else nearness to water, which is an
    assumption; null without a flag and a valid point."""
    close = proximity.distance_to_nearest(properties, waters, "property_id", metres, max_lat).withColumnRenamed("distance_m", "__m")
    out = properties.join(close, "property_id", "left")
    said = F.col(flag).cast("boolean") if flag else F.lit(None).cast("boolean")
    seen = F.when(F.coalesce(valid_point(F.col("lat"), F.col("lon")), F.lit(False)), F.col("__m").isNotNull())
    basis = F.when(said.isNotNull(), "source").when(seen.isNotNull(), "nearness (assumed)")
    return out.withColumns({"water_view": F.coalesce(said, seen), "water_basis": basis}).drop("__m")


def power_or_industrial(properties: DataFrame, permits: DataFrame, power: DataFrame, is_signal: Column, zones: tuple[str, ...], least: int, metres: float, max_lat: float = 60.0) -> DataFrame:
    """Properties near power infrastructure or with an industrial signal: two flags, then a disjunction, each with its basis."""
    close = proximity.distance_to_nearest(properties, power, "property_id", metres, max_lat)
    out = permit_operators.industrial_signal(properties, permits, is_signal, zones, least).join(close, "property_id", "left")
    near = F.when(F.col("distance_m").isNotNull(), F.concat(F.lit("power within "), F.floor("distance_m").cast("long").cast("string"), F.lit(" m")))
    return out.withColumn("basis", F.concat(F.array_compact(F.array(near)), "basis")).filter(F.size("basis") > 0)
