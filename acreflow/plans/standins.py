"""Curated tables from the bench fixtures, which hold no land records: each is a stand-in that a docstring names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def point(key: str, lat: int, lon: int) -> tuple[Column, Column]:
    """Artificial coordinates from a key."""
    at = lambda low, k, step: F.lit(low) + (F.col(key) * k % 1000) * F.lit(step)
    return at(41.3, lat, 0.0004), at(-90.9, lon, 0.0008)


def prov(source: str, record: str) -> Column:
    """Provenance without a clock, so that results repeat."""
    none = lambda t: F.lit(None).cast(t)
    return F.struct(F.lit(source).alias("source_id"), F.col(record).cast("string").alias("source_record_id"), none("string").alias("source_url"), none("timestamp_ntz").alias("collected_at"), F.lit("fixture").alias("run_id"), F.sha2(F.col(record).cast("string"), 256).alias("content_sha256"), none("string").alias("source_file"), none("long").alias("source_row"))


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer: balance as acreage (not positive: missing), segment as zoning and land use."""
    acres = (F.col("c_acctbal").cast("decimal(12,2)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(12,4)")
    lat, lon = point("c_custkey", 7919, 104729)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("property_id"), F.col("c_name").alias("parcel_no"), F.when(F.col("c_acctbal") > 0, acres).alias("acreage"),
        F.col("c_mktsegment").alias("land_use"), F.col("c_mktsegment").alias("zoning"), F.col("c_nationkey").alias("owner_id"), lat.alias("lat"), lon.alias("lon"), prov("customer", "c_custkey").alias("prov"),
    )


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("transfer_id"), F.col("o_custkey").alias("property_id"), F.to_date("o_orderdate").alias("transfer_date"), F.col("o_totalprice").cast("decimal(14,2)").alias("price"))


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order's customer and its part's type; the return flag is the permit's type."""
    line, order, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    out = line.join(order.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("property_id")), "l_orderkey").join(part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey", "left")
    return out.select("property_id", F.col("l_returnflag").alias("permit_type"), F.to_date("l_shipdate").alias("issued_date"), F.col("l_suppkey").alias("contractor_id"), F.col("p_type").alias("description"))


def contractors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier."""
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("contractor_id"), F.col("s_name").alias("name"))


def pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier, at artificial points."""
    lat, lon = point("s_suppkey", 6101, 3571)
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("poi_id"), lat.alias("lat"), lon.alias("lon"))


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: user_id mod 10 as source, value as seconds, the type error as failure."""
    return table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("source"), F.col("event_type").alias("stage"), F.col("value").alias("seconds"), F.col("ts").alias("at"), (F.col("event_type") == "error").alias("failed"))
