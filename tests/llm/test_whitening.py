"""Whitening against numpy's eigenvalues and exact integer sums."""

import math

import numpy as np
import pytest

from acreflow.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def run(spark, rows, schema=SCHEMA, **more):
    return [r.asDict() for r in W.whitened(spark.createDataFrame(rows, schema), **more).collect()]


def fitted(vectors):
    """(distinct integer vectors, eigenvalues, eigenvectors) of a list of vectors, by numpy."""
    x = np.unique(np.floor(256 * np.asarray(vectors, np.float32).astype(np.float64)).astype(np.int64), axis=0)
    z = x - x.mean(axis=0)
    e, v = np.linalg.eigh(z.T @ z / len(x))
    return x, e[::-1], v[:, ::-1]


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    data = (rng.standard_normal((300, 24)) * np.geomspace(3, 0.01, 24)) @ np.linalg.qr(rng.standard_normal((24, 24)))[0]
    data = np.concatenate([data, data[:40], data[:1].repeat(50, axis=0)]).astype(np.float32)
    got = run(spark, [(i, v.tolist()) for i, v in enumerate(data)])
    x, e, v = fitted(data)
    all_x = np.floor(256 * data.astype(np.float64)).astype(np.int64)
    assert len(got) == 4 * len(data) and {r["n"] for r in got} == {len(x)}
    sums = x.sum(axis=0)
    table = np.zeros((len(data), 4))
    for r in got:
        i, k = r["vec_id"], r["component"] - 1
        assert r["deviation"] == sum((len(x) * int(a) - int(s)) ** 2 for a, s in zip(all_x[i], sums, strict=True))
        assert r["explained"] == pytest.approx(e[k] / e.sum(), rel=1e-9) and 0 <= r["identity_error"] < 1e-9
        table[i, k] = r["whitened"]
    want = (all_x - x.mean(axis=0)) @ v[:, :4] / np.sqrt(e[:4])
    for k in range(4):
        sign = np.sign(table[0, k] * want[0, k])
        assert np.allclose(table[:, k] * sign, want[:, k], rtol=1e-8, atol=1e-8)


def test_small_eigenvalues_are_accurate():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 8, 33):
        scale = np.geomspace(1e6, 1e-6, n)
        m = rng.standard_normal((n + 40, n))
        a = (m.T @ m / len(m)) * scale[:, None] * scale[None, :]
        e, v = W.jacobi(a)
        assert np.allclose(v.T @ v, np.eye(n), atol=1e-13)
        # one-sided: singular values of the scaled factor are accurate to their own size
        inner = np.linalg.cholesky(m.T @ m / len(m))
        s = np.linalg.svd(inner * scale[:, None], compute_uv=False) ** 2
        assert np.allclose(e[: max(1, n // 2)], s[: max(1, n // 2)], rtol=1e-10)
        assert (e > 0).all()
        assert all(np.linalg.norm(a @ v[:, i] - e[i] * v[:, i]) <= 1e-12 * e[0] for i in range(n))
    assert W.jacobi(np.zeros((3, 3)))[0].tolist() == [0, 0, 0] and len(W.jacobi(np.zeros((0, 0)))[0]) == 0


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [])]) == []
    one = run(spark, [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.5, 0.25])])
    assert len(one) == 6 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in one)
    assert {r["component"] for r in one} == {1, 2} and sorted(str(r["vec_id"]) for r in one) == ["1"] * 4 + ["None"] * 2
    flat = run(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(5)])
    assert [r["whitened"] is None for r in sorted(flat, key=lambda r: (r["component"], r["vec_id"]))] == [False] * 5 + [True] * 10
    assert math.isclose(next(r["explained"] for r in flat if r["component"] == 1), 1.0) and all(r["identity_error"] < 1e-9 for r in flat)


def test_lengths_large_numbers_and_names(spark):
    rows = [(i, [float(i % 3), float(i)], 1, "a") for i in range(6)] + [(10 + i, [float(i * i)], 2, "b") for i in range(4)]
    got = run(spark, rows, "vec_id long, embedding array<double>, n int, x string")
    assert {r["n"] for r in got if r["vec_id"] < 10} == {6} and {r["n"] for r in got if r["vec_id"] >= 10} == {4}
    assert {r["component"] for r in got if r["vec_id"] >= 10} == {1}
    got = run(spark, [(1, [1e30, -1e30]), (2, [0.0, 1.0]), (3, [-1.0, 3.0])], "vec_id long, embedding array<double>")
    assert all(r["deviation"] is None for r in got if r["vec_id"] == 1) and len(got) == 6
    near = [[2.0**40, 1.0], [2.0**40 + 1, 5.0], [2.0**40 + 4, 2.0]]
    got = run(spark, [(i, v) for i, v in enumerate(near)], "vec_id long, embedding array<double>")
    small = run(spark, [(i, [v[0] - 2.0**40, v[1]]) for i, v in enumerate(near)], "vec_id long, embedding array<double>")
    key = lambda r: (r["vec_id"], r["component"])
    for a, b in zip(sorted(got, key=key), sorted(small, key=key), strict=True):
        assert a["deviation"] == b["deviation"] and abs(a["whitened"]) == pytest.approx(abs(b["whitened"]), rel=1e-9)
