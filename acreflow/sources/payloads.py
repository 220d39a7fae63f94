"""Payloads whose shape drifts: JSON kept as variants, the kinds found in it, and typed fields with what does not fit set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kind_of(value: Column) -> Column:
    """object, array, string, number, boolean or null, of a variant."""
    name = F.schema_of_variant(value)
    out = F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array").when(name == "STRING", "string")
    return out.when(name == "BOOLEAN", "boolean").when(name == "VOID", "null").otherwise("number")


def shapes(df: DataFrame, column: str) -> DataFrame:
    """(field, kind, n_rows): which kinds of value the top fields of a JSON column have, and how often.

    Rows that hold none or cannot be parsed are counted as kind ``missing`` or ``broken`` of field null.
    """
    spark, text = df.sparkSession, F.col(f"`{column}`")
    rows = df.select(text.alias("text"), F.try_parse_json(text).alias("v"))
    fields = rows.filter("v is not null").select("v").lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(F.col("key").alias("field"), kind_of(F.col("value")).alias("kind"))
    other = rows.filter("v is null").select(F.lit(None).cast("string").alias("field"), F.when(F.col("text").isNull(), "missing").otherwise("broken").alias("kind"))
    return fields.unionByName(other).groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n_rows"))


def typed(df: DataFrame, column: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with a column for each of ``fields`` (name -> (path, type)) and ``set_aside``, the names of those that are there but do
    not fit their type (``*`` if the whole cannot be parsed).  A field that is absent, or null, is null."""
    v = F.try_parse_json(F.col(f"`{column}`"))
    held = df.withColumn("__v", v)
    get = lambda path, kind: F.try_variant_get(F.col("__v"), path, kind)
    there = lambda path: get(path, "variant").isNotNull() & ~F.is_variant_null(get(path, "variant"))
    bad = [F.when(F.col("__v").isNull() & F.col(f"`{column}`").isNotNull(), F.lit("*"))]
    bad += [F.when(there(path) & get(path, kind).isNull(), F.lit(name)) for name, (path, kind) in fields.items()]
    return held.withColumns({name: get(path, kind) for name, (path, kind) in fields.items()} | {"set_aside": F.array_compact(F.array(*bad))}).drop("__v")
