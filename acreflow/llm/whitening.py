"""Embedding whitening by cyclic Jacobi rotations.

The distinct vectors' centred scatter is summed up where they lie: each task multiplies its own centred rows, and the sums of
its products meet entry by entry.  The driver gets one matrix of the vectors' length squared and turns it by symmetric
Jacobi rotations, pair after pair in a fixed cyclic order, until nothing is left off the diagonal; that keeps small
eigenvalues accurate.  The leading directions, each over the root of its eigenvalue, are broadcast (length squared numbers at
most) and project all rows.

Vectors are integers, ``floor(SCALE * c)``, so sums and deviations are exact.  Vectors of different lengths are
populations of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreflow.llm.textblocks import tidy
from acreflow.plans.storage import stored

#: Steps of a component, components in the result.
SCALE, COMPONENTS = 256, 4
#: Rows that are multiplied at once.
ROWS = 4096
_HALF = 1 << 32
_MOST = 2**63 - 1


def whole(v: Column) -> Column:
    """Whether a vector is there and holds neither nulls nor numbers that are not finite."""
    return F.coalesce(F.forall(v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))), F.lit(False))


def steps(v: Column) -> Column:
    """The vector as longs; what does not fit into one is the nearest that does."""
    return F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long") + F.lit(0).cast("long"))


def jacobi(a: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a symmetric matrix, by falling eigenvalue.

    Each sweep turns every pair of coordinates once, in rounds of pairs that do not meet.  An entry counts as gone where
    it is below rounding beside both its diagonal entries, so small eigenvalues are settled by their own size.
    """
    a, n = np.array(a, np.float64), len(a)
    v = np.eye(n)
    players = list(range(n + n % 2))
    tiny = np.finfo(float).eps
    for _ in range(sweeps):
        turned = 0
        for _ in range(len(players) - 1):
            pairs = [(min(x, y), max(x, y)) for x, y in zip(players[: len(players) // 2], players[::-1], strict=False) if max(x, y) < n]
            p, q = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
            off = a[p, q]
            some = np.abs(off) > tiny * np.sqrt(np.abs(a[p, p] * a[q, q]))
            p, q, off = p[some], q[some], off[some]
            if len(p):
                turned += len(p)
                half = (a[q, q] - a[p, p]) / (2 * off)
                t = np.where(half >= 0, 1.0, -1.0) / (np.abs(half) + np.hypot(half, 1.0))
                c = 1 / np.hypot(t, 1.0)
                s = t * c
                for m, axis in ((a, 0), (a, 1), (v, 1)):
                    x, y = (m[p], m[q]) if axis == 0 else (m[:, p].T, m[:, q].T)
                    new = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
                    if axis == 0:
                        m[p], m[q] = new
                    else:
                        m[:, p], m[:, q] = new[0].T, new[1].T
                a[p, q] = a[q, p] = 0.0
            players = [players[0], players[-1], *players[1:-1]]
        if not turned:
            break
    order = np.argsort(-np.diag(a), kind="stable")
    return np.diag(a)[order], v[:, order]


def _vectors(batch: pa.RecordBatch, name: str = "x") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix of longs) for the vectors of one length, ``ROWS`` at a time."""
    column = batch.column(name)
    offsets = column.offsets.to_numpy()
    flat, lengths = column.values.to_numpy(zero_copy_only=False), np.diff(offsets)
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        for at in range(0, len(rows), ROWS):
            own = rows[at : at + ROWS]
            yield dim, own, flat[offsets[own][:, None] + np.arange(dim)]


@tidy
def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By length and dimension: rows, and the sums of the upper and lower halves of the numbers."""
    held: dict[int, list] = {}
    for batch in batches:
        for dim, own, x in _vectors(batch):
            n, high, low = held.setdefault(dim, [0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)])
            held[dim] = [n + len(own), high + (x >> 32).sum(axis=0), low + (x & (_HALF - 1)).sum(axis=0)]
    for dim, (n, high, low) in held.items():
        at = [0] if not dim else range(dim)
        pad = lambda v: v if dim else np.zeros(1, np.int64)  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays([pa.array([dim] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array([n] * len(at), pa.int64()), pa.array(pad(high)), pa.array(pad(low))], ["dim", "j", "n", "high", "low"])


@dataclass(frozen=True)
class Law:
    """What is known of the vectors of one length: their number, exact sums, and the whitening matrix."""

    n: int
    sums: list[int]
    matrix: np.ndarray | None = None
    explained: np.ndarray | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once: the whole part of the mean goes off exactly."""
        whole_ = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s - int(w) * self.n) / self.n for s, w in zip(self.sums, whole_, strict=True)])
        small = np.abs(x) < 2**61
        return np.where(small, (np.where(small, x, 0) - whole_).astype(np.float64), x.astype(np.float64) - whole_) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n*x - S)^2 of each row, exactly; null where it does not fit into a long."""
        most = max((int(np.abs(x).max()) if x.size else 0) * self.n + max((abs(s) for s in self.sums), default=0), 1)
        if most**2 * max(1, x.shape[1]) <= _MOST:
            return ((x * self.n - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((x.astype(object) * self.n - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [int(d) if d <= _MOST else None for d in exact]


def _products(shared, project: bool):
    """By length: the entries (i <= j) of the sum of products of centred rows, or of whitened ones."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        laws, held = shared.value, {}
        for batch in batches:
            for dim, _, x in _vectors(batch):
                z = laws[dim].centred(x)
                if project:
                    z = z @ laws[dim].matrix
                held[dim] = held.get(dim, 0.0) + z.T @ z
        for dim, m in held.items():
            i, j = np.triu_indices(len(m))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dim)), pa.array(i), pa.array(j), pa.array(m[i, j])], ["dim", "i", "j", "v"])

    return run


def _matrices(vectors: DataFrame, shared, project: bool, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    rows = vectors.mapInArrow(_products(shared, project), "dim long, i long, j long, v double").groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect()
    out = {dim: np.zeros((k, k)) for dim, k in sizes.items()}
    for r in rows:
        out[r["dim"]][r["i"], r["j"]] = out[r["dim"]][r["j"], r["i"]] = r["v"]
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[dict[int, Law], dict[int, float | None]]:
    """(laws, identity errors) by length, of a table of distinct vectors ``x`` (array of longs).

    The driver holds a matrix for each length; their number is that of the lengths that occur.
    """
    spark, sums = vectors.sparkSession, {}
    halves = vectors.mapInArrow(_sums, "dim long, j long, n long, high long, low long").groupBy("dim", "j").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    for r in halves.collect():  # as many as a vector has dimensions
        n, own = sums.setdefault(r["dim"], (r["n"], [0] * r["dim"]))
        if r["dim"]:
            own[r["j"]] = int(r["high"]) * _HALF + int(r["low"])
    laws = {dim: Law(n, own) for dim, (n, own) in sums.items()}
    scatter = _matrices(vectors, spark.sparkContext.broadcast(laws), False, {dim: dim for dim in laws})
    for dim, law in laws.items():
        e, v = jacobi(scatter[dim] / law.n)
        able = int((e[:components] > dim * np.finfo(float).eps * max(e.max(initial=0), 0)).sum()) if dim else 0
        laws[dim] = Law(law.n, law.sums, v[:, :able] / np.sqrt(e[:able]), e[: min(components, dim)] / e.sum() if e.sum() > 0 else np.full(min(components, dim), np.nan))
    if not laws:
        return laws, {}
    # Whitened rows are linear in centred ones, so they are centred themselves.
    met = _matrices(vectors, spark.sparkContext.broadcast(laws), True, {dim: law.matrix.shape[1] for dim, law in laws.items()})
    return laws, {dim: float(np.abs(m / laws[dim].n - np.eye(len(m))).max()) if len(m) else None for dim, m in met.items()}


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _projected(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        laws, errors = shared.value
        for batch in batches:
            ids = batch.column("vec_id")
            for dim, own, x in _vectors(batch):
                law = laws[dim]
                k = len(law.explained)
                white = np.full((len(own), k), np.nan)
                white[:, : law.matrix.shape[1]] = law.centred(x) @ law.matrix
                each = lambda v: pa.array(v).take(pa.array(np.repeat(np.arange(len(own)), k)))  # noqa: B023, E731
                nan = lambda v: pa.array(v, from_pandas=True)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(np.repeat(own, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(own))), pa.array(np.full(len(own) * k, law.n)), each(pa.array(law.deviations(x), pa.int64())),
                    nan(white.ravel()), nan(np.tile(law.explained, len(own))), pa.array([errors[dim]] * (len(own) * k), pa.float64()),
                ], [f.split()[0] for f in _OUT.split(", ")])

    return run


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: ``components`` rows (as many as the vector is long,
    if fewer) for each row of ``vectors`` (vec_id, embedding, more).

    Rows whose embedding is null or holds null or non-finite entries are left out.  x = floor(256 * c); the fit list is
    each distinct x once, n of them.  ``deviation`` is null where it does not fit into a long; ``whitened`` is null for
    components whose eigenvalue is 0 but for rounding (constant or repeated dimensions, a single vector), ``explained`` where
    all are, ``identity_error`` (over the components that are not null) likewise.  Vectors of one length are
    fitted among themselves; empty ones have no components.  Repeated rows and null ids come back as rows like any other.
    An empty table gives none.  Other columns are ignored.
    """
    source = vectors.filter(whole(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), steps(F.col("embedding")).alias("x"))
    distinct = stored(source.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "vectors")
    fitted = fit(distinct, components)
    return source.mapInArrow(_projected(vectors.sparkSession.sparkContext.broadcast(fitted)), _OUT)
