"""Distance joins on a grid: an equi join on cells, then the exact great-circle distance.

Points fall into cells at least as large as the radius, so everything within reach of a point lies in its own
or the eight cells around it.  The side with fewer rows should be ``right``: it is copied nine times.  Longitude
cells are sized for the latitude farthest from the equator that is asked for.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreflow.functions.columns import DEGREE_M, haversine_m, valid_point
from acreflow.plans.storage import checkpointed

#: Metres within which the nearest place is looked for.
FARTHEST = 2_000_000.0


def cell_degrees(radius_m: float, max_lat: float) -> tuple[float, float]:
    """Cell sizes in degrees of latitude and longitude that cover ``radius_m`` up to latitude ``max_lat``."""
    lat = 1.01 * radius_m / DEGREE_M
    reach = min(abs(max_lat) + lat, 89.9)
    return lat, 1.01 * radius_m / (DEGREE_M * math.cos(math.radians(reach)))




def _celled(left: DataFrame, right: DataFrame, radius_m: float, max_lat: float) -> tuple[DataFrame, DataFrame]:
    """Both sides with their cells __y and __x, the right one copied into the cells around; its point is __lat, __lon."""
    dlat, dlon = cell_degrees(radius_m, max_lat)
    wrap = max(1, math.floor(360 / dlon))
    dlon = 360 / wrap
    row = lambda lat: F.floor(lat / F.lit(dlat)).cast("int")
    column = lambda lon: F.pmod(F.floor((lon + 180) / F.lit(dlon)).cast("int"), F.lit(wrap))
    around = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    a = left.filter(valid_point(F.col("lat"), F.col("lon"))).withColumns({"__y": row(F.col("lat")), "__x": column(F.col("lon"))})
    b = right.filter(valid_point(F.col("lat"), F.col("lon"))).withColumnsRenamed({"lat": "__lat", "lon": "__lon"})
    b = b.withColumn("__dy", F.explode(around)).withColumn("__dx", F.explode(F.array_distinct(F.transform(around, lambda d: F.pmod(column(F.col("__lon")) + d, F.lit(wrap))))))
    return a, b.withColumns({"__y": row(F.col("__lat")) + F.col("__dy"), "__x": F.col("__dx")}).drop("__dy", "__dx")


def _pairs(left: DataFrame, right: DataFrame, radius_m: float, max_lat: float, on: tuple[str, ...] = ()) -> DataFrame:
    """The pairs of ``within``."""
    a, b = _celled(left, right, radius_m, max_lat)
    pairs = a.join(b, ["__y", "__x", *on]).withColumn("distance_m", haversine_m(F.col("lat"), F.col("lon"), F.col("__lat"), F.col("__lon")))
    return pairs.filter(F.col("distance_m") <= radius_m).drop("__y", "__x", "__lat", "__lon")


def within(left: DataFrame, right: DataFrame, radius_m: float, max_lat: float = 60.0, on: tuple[str, ...] = ()) -> DataFrame:
    """All pairs of a row of ``left`` and one of ``right`` (lat, lon, more) at most ``radius_m`` apart that are equal in ``on``.

    Columns of ``right`` must have other names than those of ``left`` but for ``on`` and for lat and lon, which are left's;
    adds distance_m.  Rows without a valid point, or with a null in ``on``, pair with nothing; points beyond ``max_lat`` raise
    no error but may be missed, so give the data's own bound.
    """
    return _pairs(left, right, radius_m, max_lat, on)


def near(left: DataFrame, right: DataFrame, key: str, radius_m: float, max_lat: float = 60.0) -> DataFrame:
    """The rows of ``left`` with any row of ``right`` within ``radius_m``, once each; no pairs are made.  ``key`` may repeat.
    Rows of ``right`` at one point count as one."""
    a, b = _celled(left, right.select("lat", "lon").distinct(), radius_m, max_lat)
    b = b.withColumnsRenamed({"__y": "__by", "__x": "__bx"})
    close = haversine_m(F.col("lat"), F.col("lon"), F.col("__lat"), F.col("__lon")) <= radius_m
    return a.join(b, (F.col("__y") == F.col("__by")) & (F.col("__x") == F.col("__bx")) & close, "left_semi").select(*(F.col(f"`{c}`") for c in left.columns))


def _least(points: DataFrame, spots: DataFrame, radius_m: float, max_lat: float) -> DataFrame:
    """(lat, lon, distance_m): how far the nearest spot within ``radius_m`` is.  Pairs go into a hash table of the points as
    they are made and are not sorted, so a task's memory follows its points and spots, however dense they are."""
    return within(points, spots.select("lat", "lon"), radius_m, max_lat).groupBy("lat", "lon").agg(F.min("distance_m").alias("distance_m"))


def distance_to_nearest(left: DataFrame, right: DataFrame, key: str, radius_m: float, max_lat: float = 60.0) -> DataFrame:
    """(key, distance_m): how far the nearest row of ``right`` is, for the rows of ``left`` that have one within ``radius_m``.
    Distances are taken between distinct points."""
    rows = left.select(key, "lat", "lon").filter(valid_point(F.col("lat"), F.col("lon")))
    out = _least(rows.select("lat", "lon").distinct(), right.select("lat", "lon").distinct(), radius_m, max_lat)
    return rows.join(out, ["lat", "lon"]).groupBy(key).agg(F.min("distance_m").alias("distance_m"))


def nearest(left: DataFrame, right: DataFrame, key: str, right_key: str, radius_m: float, max_lat: float = 60.0, bounded: bool = False) -> DataFrame:
    """(key, right_key, distance_m): the nearest row of ``right``; of equally near ones the smallest right_key.

    Distances are taken between distinct points, however many rows share one.  Starts with ``radius_m`` and doubles it for
    the points that have found nothing, which are ever fewer, until all have; with ``bounded`` it stays at ``radius_m``.  A
    point found within r is final, as all of ``right`` within r was seen.  A row with nothing within ``FARTHEST`` comes back
    with nulls.  Rows without a valid point are not in the result; without any place nothing is.
    """
    spots = right.filter(valid_point(F.col("lat"), F.col("lon"))).groupBy("lat", "lon").agg(F.min(right_key).alias(right_key))
    rows = left.select(key, "lat", "lon").filter(valid_point(F.col("lat"), F.col("lon")))
    found = F.when(F.col("distance_m").isNotNull(), F.struct("distance_m", right_key))
    of_rows = lambda out: rows.join(out, ["lat", "lon"]).groupBy(key).agg(F.min(found).alias("m")).select(key, f"m.{right_key}", "m.distance_m")

    def best(points: DataFrame) -> DataFrame:
        """The least distance first, then the smallest key of the few spots that are that near; the second pass may round otherwise."""
        least = _least(points, spots, radius_m, max_lat).withColumnRenamed("distance_m", "__least")
        few = _pairs(least, spots, radius_m, max_lat).filter(F.col("distance_m") <= F.col("__least") * (1 + 1e-9))
        return few.groupBy("lat", "lon").agg(F.min(F.struct("distance_m", right_key)).alias("m")).select("lat", "lon", f"m.{right_key}", "m.distance_m")

    todo = rows.select("lat", "lon").distinct()
    out = best(todo)
    if bounded or spots.isEmpty():
        return of_rows(out)
    out = checkpointed(out)  # each ring starts from results, not from the rings before
    while True:
        todo = checkpointed(todo.join(out.select("lat", "lon"), ["lat", "lon"], "left_anti"))
        if todo.isEmpty():
            return of_rows(out)
        if radius_m >= FARTHEST:
            return of_rows(out.unionByName(todo.select("lat", "lon", F.lit(None).cast(dict(spots.dtypes)[right_key]).alias(right_key), F.lit(None).cast("double").alias("distance_m"))))
        radius_m = min(2 * radius_m, FARTHEST)
        out = out.unionByName(checkpointed(best(todo)))
