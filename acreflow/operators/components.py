"""Connected components of an edge table, fully distributed.

Alternates two contractions until nothing changes: every node hands its larger neighbours to its smallest
neighbour, then its smaller neighbours to the smallest of them.  Both are a map-side combined ``min`` and
a plain equi join, so a hub with a third of all edges is split by the adaptive skew join; no neighbour
list is ever gathered.  Each round ends in a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreflow.plans.storage import checkpointed

MAX_ROUNDS = 60


def _stamp(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _pairs(df: DataFrame, u: Column, v: Column) -> DataFrame:
    return df.select(u.alias("u"), v.alias("v"))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Edges are undirected; loops, repeated edges and edges with a null end add nothing.  A node that only
    has loops is not returned.  An empty edge table gives an empty result.  Ids of any orderable type.
    Raises ``RuntimeError`` if it has not settled after ``MAX_ROUNDS``; it never truncates.
    """
    x, y = F.col(a), F.col(b)
    e = checkpointed(_pairs(edges.filter(x != y), F.greatest(x, y), F.least(x, y)).distinct())
    stamp = _stamp(e)
    if not stamp[0]:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(_pairs(e, F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        e = _pairs(both.join(low, "u").filter("v > u"), F.col("v"), F.col("w")).distinct()
        low = e.groupBy("u").agg(F.min("v").alias("w"))
        moved = _pairs(e.join(low, "u").filter("v > w"), F.col("v"), F.col("w"))
        e = checkpointed(moved.unionByName(_pairs(low, F.col("u"), F.col("w"))).distinct())
        before, stamp = stamp, _stamp(e)
        if stamp == before:
            roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    raise RuntimeError(f"components have not settled after {MAX_ROUNDS} rounds")
