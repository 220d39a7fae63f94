"""Connected components that are kept from run to run.

Kept are two tables in hash buckets.  *nodes*: each node with the label it got when it was first seen, written once.
*moves*: labels that have become part of a component with a smaller one.  A run looks up the nodes of its new edges in their
buckets, follows their labels' moves to the labels that stand now, joins these by the new edges, and appends new
nodes and moves.  Nothing is rewritten, and no bucket without a node or label of the run is read.

A run counts when a pointer file names its folders, as its last step; one that breaks before leaves nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreflow.operators.components import connected_components
from acreflow.plans import commits
from acreflow.plans.storage import checkpointed

BUCKETS = 64
POINTER = "labels.json"
_NODES, _MOVES = "node long, label long, bucket int", "label long, to long, bucket int"


def _bucket(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


def _state(spark: SparkSession, folder: str) -> dict:
    said = commits.current(spark, f"{folder}/{POINTER}")
    return json.loads(said) if said else {"nodes": [], "moves": []}


def _read(spark: SparkSession, paths: list[str], schema: str, ids: DataFrame | None = None) -> DataFrame:
    """A kept table, of the buckets that ``ids`` (one column) fall into if given."""
    out = spark.createDataFrame([], schema)
    for p in paths:
        out = out.unionByName(spark.read.schema(schema).parquet(p))
    if ids is None:
        return out
    touched = [r[0] for r in ids.select(_bucket(F.col(ids.columns[0])).alias("b")).distinct().collect()]  # BUCKETS at most
    return out.filter(F.col("bucket").isin(touched))


def _followed(spark: SparkSession, labels: DataFrame, moves: list[str]) -> DataFrame:
    """(label, root) for each of ``labels`` (one column, distinct): where its moves lead.  As many rounds as the longest chain of moves."""
    now = checkpointed(labels.select(F.col(labels.columns[0]).alias("label"), F.col(labels.columns[0]).alias("root")))
    while moves:
        step = _read(spark, moves, _MOVES, now.select("root").distinct()).select(F.col("label").alias("root"), "to")
        moved = checkpointed(now.join(step, "root", "left").select("label", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("on")))
        more = moved.filter("on").limit(1).count()
        now = moved.select("label", "root")
        if not more:
            break
    return now


def extend(spark: SparkSession, folder: str, edges: DataFrame, a: str, b: str) -> dict:
    """Adds the edges of a run to what ``folder`` keeps; how many nodes and moves are new.

    Ends are integers; edges with a null end are left out, and a node that only has loops is kept alone.  Repeated edges and runs
    change nothing.
    """
    state, run = _state(spark, folder), uuid.uuid4().hex
    pairs = checkpointed(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a is not null and b is not null").distinct())
    ends = checkpointed(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    known = checkpointed(ends.join(_read(spark, state["nodes"], _NODES, ends).select("node", "label"), "node", "left"))
    roots = _followed(spark, known.filter("label is not null").select("label").distinct(), state["moves"])
    standing = checkpointed(known.join(roots, "label", "left").select("node", F.col("label").isNull().alias("new"), F.coalesce("root", "node").alias("root")))
    end = lambda x: standing.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
    met = pairs.join(end("a"), "a").join(end("b"), "b").filter("ra <> rb").select("ra", "rb").distinct()
    groups = connected_components(met, "ra", "rb").select(F.col("node").alias("root"), "component")
    joined = checkpointed(standing.join(groups, "root", "left").select("node", "new", "root", F.coalesce("component", "root").alias("label")))
    fresh = joined.filter("new").select("node", "label", _bucket(F.col("node")).alias("bucket"))
    moves = joined.filter("not new and root <> label").select(F.col("root").alias("label"), F.col("label").alias("to")).distinct().withColumn("bucket", _bucket(F.col("label")))
    out = {"nodes": fresh.count(), "moves": moves.count()}
    for name, rows in (("nodes", fresh), ("moves", moves)):
        if out[name]:
            path = f"{folder}/{name}/run-{run}"
            rows.repartition("bucket").write.partitionBy("bucket").parquet(path)
            state[name].append(path)
    commits.swap(spark, f"{folder}/{POINTER}", json.dumps(state))
    return out


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """(node, component) as of the last run: component is the smallest node that is reachable."""
    state = _state(spark, folder)
    nodes = _read(spark, state["nodes"], _NODES)
    roots = _followed(spark, nodes.select("label").distinct(), state["moves"])
    return nodes.join(roots, "label").select("node", F.col("root").alias("component"))


def compact(spark: SparkSession, folder: str) -> None:
    """Writes all nodes anew with the labels that stand, so later runs follow no moves."""
    run = uuid.uuid4().hex
    path = f"{folder}/nodes/run-{run}"
    labels(spark, folder).select("node", F.col("component").alias("label"), _bucket(F.col("node")).alias("bucket")).repartition("bucket").write.partitionBy("bucket").parquet(path)
    commits.swap(spark, f"{folder}/{POINTER}", json.dumps({"nodes": [path], "moves": []}))
