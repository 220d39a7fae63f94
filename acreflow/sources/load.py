"""Loading curated tables from files, with provenance, and setting malformed rows aside."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreflow.functions.columns import digest
from acreflow.plans.schemas import columns


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Rows of files as they are; their hidden _metadata column says where each is from.  CSV columns are strings."""
    reader = spark.read.format(fmt).options(**({"header": "true"} | options if fmt == "csv" else options))
    return reader.load(path)


def origin(raw: DataFrame) -> tuple[Column, Column]:
    """(file, place in it) of each row of files; the place is null for formats that number no rows, both for other rows."""
    none = F.lit(None)
    try:
        fields = raw.select("_metadata").schema[0].dataType.names
    except AnalysisException:  # not rows of files
        return none.cast("string"), none.cast("long")
    return F.col("_metadata.file_path"), F.col("_metadata.row_index") if "row_index" in fields else none.cast("long")


def raw_rows(records: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """``key`` of ``records`` (with prov), source_file, source_row, and ``raw``: the columns of the row of ``raw`` that each was
    loaded from.  Rows of formats that number no rows, or of other files, are not found and left out."""
    at = records.select(key, F.col("prov.source_file").alias("source_file"), F.col("prov.source_row").alias("source_row")).filter("source_file is not null and source_row is not null")
    file, row = origin(raw)
    there = raw.select(file.alias("source_file"), row.alias("source_row"), F.struct(*(F.col(f"`{c}`") for c in raw.columns)).alias("raw"))
    return at.join(there, ["source_file", "source_row"]).select(key, "source_file", "source_row", "raw")


def try_as(column: Column, kind: str) -> Column:
    """A value in the curated type, null if it cannot be; never an error."""
    text = F.trim(column.cast("string"))
    if kind == "date":
        return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "MM/dd/yyyy"), F.to_date(F.try_to_timestamp(text)))
    return text if kind == "string" else text.try_cast(kind)


def parse(raw: DataFrame, kind: str, required: tuple[str, ...], names: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad): the curated columns of ``kind``, and the rows set aside with their reasons.

    A row is bad if a required value is missing or a value that is there does not fit its type.  ``names``
    maps curated names to raw ones; columns that the source lacks are null.
    """
    names, have = names or {}, set(raw.columns)
    spec = [(c, t, names.get(c, c)) for c, t in columns(kind)]
    value = {c: try_as(F.col(f"`{n}`"), t) if n in have else F.lit(None).cast(t) for c, t, n in spec}
    there = lambda n: F.col(f"`{n}`").isNotNull() & (F.trim(F.col(f"`{n}`").cast("string")) != "")
    reasons = [F.when(value[c].isNull() & there(n), F.lit(f"{c}: not a {t}")) for c, t, n in spec if n in have]
    reasons += [F.when(value[c].isNull(), F.lit(f"{c}: missing")) for c in required]
    marked = raw.withColumn("__why", F.array_compact(F.array(*reasons)))
    more = [F.col("prov")] if "prov" in have else []
    good = marked.filter("size(__why) = 0").select(*(value[c].alias(c) for c, _, _ in spec), *more)
    bad = marked.filter("size(__why) > 0").select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in raw.columns))).alias("raw"), F.col("__why").alias("reasons"))
    return good, bad


def with_prov(df: DataFrame, source_id: str, run_id: str, record_id: Column, url: Column | None = None, collected_at: Column | None = None) -> DataFrame:
    """Adds the provenance struct to each row; the digest covers all columns in their order.  Rows of files keep their file and place in it."""
    file, row = origin(df)
    at = collected_at if collected_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return df.withColumn("prov", F.struct(
        F.lit(source_id).alias("source_id"), record_id.cast("string").alias("source_record_id"), (url if url is not None else F.lit(None).cast("string")).alias("source_url"),
        at.cast("timestamp_ntz").alias("collected_at"), F.lit(run_id).alias("run_id"), digest(*(F.col(f"`{c}`") for c in df.columns)).alias("content_sha256"),
        file.alias("source_file"), row.alias("source_row"),
    ))


def load(spark: SparkSession, kind: str, path: str, source_id: str, run_id: str, required: tuple[str, ...] | None = None, fmt: str = "parquet", names: dict[str, str] | None = None, url: str | None = None, **options: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of one curated kind, with provenance."""
    raw = read_raw(spark, path, fmt, **options)
    first = (names or {}).get(columns(kind)[0][0], columns(kind)[0][0])
    stamped = with_prov(raw, source_id, run_id, F.col(f"`{first}`"), F.lit(url) if url else F.lit(path))
    return parse(stamped, kind, required or (columns(kind)[0][0],), names)


def load_poi(spark: SparkSession, kind: str, path: str, source_id: str, run_id: str, fmt: str = "parquet", **options: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) points of interest of one kind (transit, starbucks, power, water)."""
    good, bad = load(spark, "poi", path, source_id, run_id, ("poi_id", "lat", "lon"), fmt, **options)
    return good.filter(F.lower("kind") == kind.lower()), bad


def link_only(spark: SparkSession, source_id: str, run_id: str, urls: list[str]) -> DataFrame:
    """Zoning rows that only say where the data is, for sources that are linked instead of loaded."""
    base = spark.createDataFrame([(u,) for u in urls], "source_url string")
    rows = base.select(*(F.lit(None).cast(t).alias(c) if c not in ("source_url", "link_only") else (F.col("source_url") if c == "source_url" else F.lit(True).alias(c)) for c, t in columns("zoning")))
    return with_prov(rows, source_id, run_id, F.col("source_url"), F.col("source_url"))


def assert_county(df: DataFrame, county: str) -> DataFrame:
    """``df`` if all its rows are of ``county`` (null is not); raises ``ValueError`` otherwise."""
    other = df.agg(F.count_if(~F.coalesce(F.upper(F.trim("county")) == county.upper(), F.lit(False)))).first()[0]
    if other:
        raise ValueError(f"{other} rows are not of {county}")
    return df


def with_location(properties: DataFrame, locations: DataFrame) -> DataFrame:
    """Properties with coordinates from a location table where they have none of their own."""
    spots = locations.groupBy("property_id").agg(F.min(F.struct("lat", "lon")).alias("__at"))
    out = properties.join(spots, "property_id", "left")
    return out.withColumns({"lat": F.coalesce("lat", "__at.lat"), "lon": F.coalesce("lon", "__at.lon")}).drop("__at")


def new_run() -> str:
    return uuid.uuid4().hex
