"""Assemblages: adjacent parcels of one owner, as connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreflow.functions.columns import valid_point
from acreflow.operators.components import connected_components
from acreflow.operators.proximity import within


def spots_of(parcels: DataFrame) -> DataFrame:
    """(property_id, spot): parcels with an owner and a valid point; spot is the least of its owner's parcels at its point."""
    own = parcels.select("property_id", "owner_id", "lat", "lon").filter(F.col("owner_id").isNotNull() & valid_point(F.col("lat"), F.col("lon")))
    at = ["owner_id", "lat", "lon"]
    return own.join(own.groupBy(*at).agg(F.min("property_id").alias("spot")), at).select("property_id", "spot", *at)


def adjacent_spots(parcels: DataFrame, distance_m: float, max_lat: float = 60.0) -> DataFrame:
    """(a, b), a < b, spots of one owner that are within ``distance_m`` or have a parcel in common; copies of a point are no pairs."""
    own = spots_of(parcels)
    end = lambda x: own.groupBy(F.col("owner_id").alias("owner"), "lat", "lon").agg(F.min("spot").alias(x))
    close = within(end("a"), end("b"), distance_m, max_lat, ("owner",)).filter("a < b").select("a", "b")
    twice = own.groupBy("property_id").agg(F.min("spot").alias("a"), F.max("spot").alias("last")).filter("a < last").select("property_id", "a")
    return close.unionByName(own.join(twice, "property_id").select("a", F.col("spot").alias("b")).filter("a < b"))


def assemblage_of(parcels: DataFrame, distance_m: float, max_lat: float = 60.0) -> DataFrame:
    """(property_id, assemblage_id) of every parcel; a parcel alone is its own assemblage."""
    groups = connected_components(adjacent_spots(parcels, distance_m, max_lat), "a", "b")
    placed = spots_of(parcels).join(groups, F.col("spot") == F.col("node"), "left").groupBy("property_id").agg(F.min(F.coalesce("component", "spot")).alias("assemblage_id"))
    return parcels.select("property_id").join(placed, "property_id", "left").select("property_id", F.coalesce("assemblage_id", "property_id").alias("assemblage_id"))


def assemblages(parcels: DataFrame, distance_m: float, min_acres: float, least: int = 2, max_lat: float = 60.0) -> DataFrame:
    """assemblage_id, n_parcels, acreage (exact), members, of at least ``least`` parcels and ``min_acres``.

    Parcels without a known acreage add nothing to it; n_unknown says how many there are.
    """
    own = parcels.select("property_id", "acreage").join(assemblage_of(parcels, distance_m, max_lat), "property_id")
    out = own.groupBy("assemblage_id").agg(
        F.count(F.lit(1)).alias("n_parcels"), F.sum("acreage").alias("acreage"), F.count_if(F.col("acreage").isNull()).alias("n_unknown"), F.sort_array(F.collect_list("property_id")).alias("members")
    )
    return out.filter((F.col("n_parcels") >= least) & (F.col("acreage") >= F.lit(min_acres)))
