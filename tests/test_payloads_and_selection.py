"""Payloads of mixed shapes, and percentiles against sorting."""

import math
import random

import pytest

from acreflow.operators import selection
from acreflow.sources import payloads


def test_shapes_and_typed_fields(spark):
    rows = [(1, '{"a": 1, "b": {"c": [5]}}'), (2, '{"a": "7"}'), (3, '{"a": "x", "b": null}'), (4, '{"a": tru'), (5, None), (6, "[1]"), (7, '{"a": 1.5, "d": true}'), (8, "{}")]
    df = spark.createDataFrame(rows, "id int, p string")
    got = {(r["field"], r["kind"]): r["n_rows"] for r in payloads.shapes(df, "p").collect()}
    assert {k: v for k, v in got.items() if k[0]} == {("a", "number"): 2, ("a", "string"): 2, ("b", "object"): 1, ("b", "null"): 1, ("d", "boolean"): 1}
    assert got[None, "missing"] == 1 and got[None, "broken"] == 1
    out = {r["id"]: (r["a"], r["c"], r["set_aside"]) for r in payloads.typed(df, "p", {"a": ("$.a", "int"), "c": ("$.b.c[0]", "int")}).collect()}
    assert out[1] == (1, 5, []) and out[2] == (7, None, []) and out[3] == (None, None, ["a"]) and out[4] == (None, None, ["*"]) and out[5] == (None, None, []) and out[8] == (None, None, [])


@pytest.mark.parametrize(("bins", "few"), [(64, 1), (1024, 10_000)])
def test_percentiles_equal_sorting(spark, bins, few):
    r = random.Random(bins)
    inf, nan = float("inf"), float("nan")
    groups = {"even": [r.random() for _ in range(300)], "same": [2.5] * 200, "few": [1.0], "far": [10.0 ** r.randrange(-300, 300) * r.choice([1, -1]) for _ in range(200)], "odd": [inf, -inf, nan, 1.0, 2.0] * 9, None: [1.0, 3.0], "wide": [-1.7e308, 1.7e308, 0.0] * 20, "none": []}
    rows = [(g, v) for g, vs in groups.items() for v in [*vs, None]]
    r.shuffle(rows)
    shares = (0.0, 0.25, 0.5, 0.95, 1.0)
    got = {(x["g"], x["share"]): x["v"] for x in selection.percentiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", shares, bins, few).collect()}
    key = lambda v: (math.isnan(v), 0.0 if math.isnan(v) else v)
    want = {(g, s): sorted(vs, key=key)[max(math.ceil(round(s * len(vs), 9)), 1) - 1] for g, vs in groups.items() if vs for s in shares}
    assert got.keys() == want.keys() and all(got[k] == v or (math.isnan(v) and math.isnan(got[k])) for k, v in want.items())
