"""Learned weights against a plain fit over pairs, entities against the true ones, labels against full recomputation."""

import json
import os
import random

import numpy as np
import pytest

from acreflow import queries
from acreflow.operators import labels, matching
from acreflow.operators.matching import Field
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.01"


def plain_fit(pairs, levels, rounds=500):
    """Expectation-maximisation over single pairs, one after the other."""
    m = [[0.1 / (k - 1)] * (k - 1) + [0.9] for k in levels]
    u = [[0.9] + [0.1 / (k - 1)] * (k - 1) for k in levels]
    share = 0.2
    for _ in range(rounds):
        sums = [[[1e-3] * k for k in levels] for _ in range(2)]
        total = 0.0
        for p in pairs:
            a, b = share, 1 - share
            for i, x in enumerate(p):
                if x is not None:
                    a, b = a * m[i][x], b * u[i][x]
            w = a / (a + b)
            total += w
            for i, x in enumerate(p):
                if x is not None:
                    sums[0][i][x] += w
                    sums[1][i][x] += 1 - w
        share = total / len(pairs)
        m, u = ([[x / sum(f) for x in f] for f in s] for s in sums)
    return m, u, share


def test_weights_equal_a_plain_fit():
    r = random.Random(1)
    fields = [Field("a", 2), Field("b"), Field("c"), Field("d")]
    pairs = []
    for _ in range(600):
        match = r.random() < 0.3
        draw = lambda p, k: None if r.random() < 0.1 else (k if r.random() < p else r.randrange(k))
        pairs.append(tuple(draw(0.9 if match else 0.1, f.levels - 1) for f in fields))
    counts = {}
    for p in pairs:
        counts[p] = counts.get(p, 0) + 1
    w = matching.fit([(*p, n) for p, n in counts.items()], fields, 60, 0)
    m, u, share = plain_fit(pairs, [f.levels for f in fields], 60)
    assert w.share == pytest.approx(share, rel=1e-6) and 0.2 < share < 0.4
    for a, b in zip((*w.m, *w.u), (*m, *u), strict=True):
        assert np.allclose(a, b, rtol=1e-6)
    assert all(x[-1] > 0 > x[0] for x in w.bits())
    assert matching.fit([], fields).share == 0.2
    fixed = matching.fit([(*p, n) for p, n in counts.items()], fields, chance=[(0, 0, 0, 0, 89), (2, 1, None, 0, 9)])
    assert np.allclose(fixed.u[0], np.array([89.5, 0.5, 9.5]) / 99.5) and np.allclose(fixed.u[2], [89.5 / 90, 0.5 / 90])


def test_agreement_levels(spark):
    rows = [("ANN LEE", "ANN LEE"), ("ANN LEE", "AN LEE"), ("A LEE", "ANN LEE"), ("A LEE", "BOB LEE"), ("ANN LEE", None), ("A", "ANN LEE"), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    f = Field("n", 1, True)
    assert [r[0] for r in df.select(f.agreement(F.col("a"), F.col("b"))).collect()] == [2, 1, 1, 0, None, 0, 2]
    names = spark.createDataFrame([("Lee, Ann",), ("ANN  LEE Jr.",), ("jr",), (None,), ("éa Bo",)], "n string").select(matching.word_key(F.col("n")).alias("w"))
    assert [r[0] for r in names.collect()] == ["ANN LEE", "ANN LEE", None, None, "A BO"]
    assert [r[0] for r in names.filter("w is not null").select(matching.longest_word(F.col("w"))).collect()] == ["ANN", "ANN", "BO"]


def test_neighbours_follow_the_records(spark):
    """A key that all records share gives each a few partners, not all."""
    df = spark.range(3000).select(F.col("id").alias("k"), F.lit("x").alias("by"), (F.col("id") % 7).alias("tie"))
    found = matching.neighbours(df, "k", F.col("by"), F.col("tie"), 4)
    assert found.count() == sum(min(4, 2999 - i) for i in range(3000)) and found.filter("a >= b").count() == 0


def test_records_and_runs_are_not_broadcast(spark):
    """Small estimates do not make the driver gather the records of a pair or the runs of a name."""
    df = spark.createDataFrame([(1, "ANN LEE"), (2, "AN LEE"), (3, "BOB RAY")], "k long, n string")
    pairs = matching.close_names(df, "k", F.col("n"), F.lit(""), 2)
    for out in (pairs, matching.patterns(df, "k", pairs.select("a", "b"), [Field("n", 2)])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan
    assert [tuple(r) for r in pairs.collect()] == [(1, 2, 1)]
    entities, _ = matching.resolve(df, "x", "k", [Field("n", 2)], [(F.col("n"), F.col("n"))], close=F.col("n"))
    assert "Broadcast" not in (plan := entities._jdf.queryExecution().executedPlan().toString()), plan


@pytest.mark.skipif(not os.path.exists(f"{DATA}/clients.parquet"), reason="needs the test tables")
def test_entities_are_mostly_right(spark):
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/clients.parquet").select("client_id", "master_id").collect()}
    found = {int(r["record_key"]): r for r in queries.resolved_clients(spark, DATA).collect()}
    assert set(found) == set(truth)

    def pairs(label):
        groups = {}
        for k in truth:
            groups.setdefault(label(k), []).append(k)
        return {(a, b) for g in groups.values() for a in g for b in g if a < b}

    want, got = pairs(lambda k: truth[k]), pairs(lambda k: found[k]["canonical_id"])
    assert len(want & got) / len(got) > 0.97 and len(want & got) / len(want) > 0.97
    assert all(r["score"] >= matching.LIKELY for r in found.values()) and {r["match_rule"] for r in found.values()} == {"weights", "self"}


def plain_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {(x, find(x)) for x in parent}


def test_labels_over_runs_equal_full_recomputation(spark, tmp_path):
    r, folder, seen = random.Random(4), str(tmp_path), []
    assert labels.labels(spark, folder).count() == 0
    for run in range(4):
        batch = [(r.randrange(120), r.randrange(120)) for _ in range(25)] + [(None, 3), (200 + run, 200 + run)]
        batch += seen[:5]
        seen += batch
        labels.extend(spark, folder, spark.createDataFrame(batch, "x long, y long"), "x", "y")
        assert {tuple(x) for x in labels.labels(spark, folder).collect()} == plain_components(seen)
        if run == 1:
            labels.compact(spark, folder)
            assert {tuple(x) for x in labels.labels(spark, folder).collect()} == plain_components(seen)
    before = (tmp_path / labels.POINTER).read_text()
    assert labels.extend(spark, folder, spark.createDataFrame(seen[-9:], "x long, y long"), "x", "y") == {"nodes": 0, "moves": 0}
    assert json.loads(before) == json.loads((tmp_path / labels.POINTER).read_text())


def test_a_run_reads_only_touched_buckets(spark, tmp_path):
    folder = str(tmp_path)
    labels.extend(spark, folder, spark.range(2000).select("id", (F.col("id") - F.col("id") % 4).alias("b")), "id", "b")
    paths = labels._state(spark, folder)["nodes"]
    few = labels._read(spark, paths, labels._NODES, spark.createDataFrame([(7,), (9,)], "node long"))
    assert len(few.inputFiles()) > 2 and 0 < few.select("bucket").distinct().count() <= 2
    assert "PartitionFilters: [isnotnull(bucket" in (plan := few._jdf.queryExecution().executedPlan().toString()) or "PartitionFilters: [bucket" in plan, plan


def test_a_broken_run_leaves_the_labels(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    edges = spark.createDataFrame([(1, 2), (3, 4)], "x long, y long")
    labels.extend(spark, folder, edges, "x", "y")
    with monkeypatch.context() as m:
        m.setattr(labels.commits, "swap", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            labels.extend(spark, folder, spark.createDataFrame([(2, 3)], "x long, y long"), "x", "y")
    assert {tuple(x) for x in labels.labels(spark, folder).collect()} == {(1, 1), (2, 1), (3, 3), (4, 3)}
    labels.extend(spark, folder, spark.createDataFrame([(2, 3), (0, 4)], "x long, y long"), "x", "y")
    assert {tuple(x) for x in labels.labels(spark, folder).collect()} == {(i, 0) for i in range(5)}
