"""Near-duplicate embeddings by spherical-cap filters.

A vector, turned by a fixed random rotation, is cut into two parts; each part has a code of B random directions,
and every choice of one direction from each code is a filter direction, B**2 in all.  A vector is list-decoded
to all filters whose direction it exceeds a limit on: of each part only directions are combined that reach the
limit with the best of the other parts.  Similar vectors exceed common filters, so rows are joined on filters and
every pair that meets is verified by its cosine in double precision.

B follows the number of vectors, so a filter holds a bounded number of unrelated ones; the limit follows from the
number of filters that a pair at the limit of cosine is expected to share (``SHARED``), and at every size from
what random pairs share.

A pair is counted where it meets first, in the smallest filter that both have: no pair is ever emitted, only
counts and a spanning set of links per filter.  Equal vectors are one class with a multiplicity.  A filter
with many rows is cut into tiles of two chunks each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreflow.operators.components import connected_components
from acreflow.plans.storage import stored

COSINE = 0.9
#: Filters that a pair at the limit shares on average.
SHARED = 14.0
#: Rows in a chunk of a filter; filters with more rows are cut into tiles.
CHUNK = 1024
#: Random pairs at the limit that the filter limit is measured on.
PAIRS = 2048


@lru_cache(maxsize=64)
def plan(n: int, cosine: float, shared: float) -> tuple[int, int, float]:
    """(parts, directions in each, threshold in standard deviations) for ``n`` vectors."""
    parts, size = 2, 64
    while size**parts < max(n, 1 << 14):
        size *= 2
    law, filters = NormalDist(), float(size) ** parts
    low, high = 0.0, 12.0
    for _ in range(60):
        mid = (low + high) / 2
        x = mid + np.linspace(0, 6, 601)
        joint = np.trapezoid(np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * np.array([1 - law.cdf((mid - cosine * v) / math.sqrt(1 - cosine**2)) for v in x]), x)
        low, high = (mid, high) if filters * joint > shared else (low, mid)
    return parts, size, low


@lru_cache(maxsize=8)
def codes(dim: int, parts: int, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation, and for each part its directions; directions of a part have the length that makes all of them add up to 1."""
    rng = np.random.default_rng(dim * 1009 + parts)
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    out = []
    for piece in np.array_split(np.arange(dim), min(parts, dim)):
        c = rng.standard_normal((size, len(piece)))
        out.append(c / np.linalg.norm(c, axis=1, keepdims=True) * math.sqrt(len(piece) / dim))
    return turn, out


def best_shared(products: list[tuple[np.ndarray, np.ndarray]]) -> float:
    """The highest limit at which a pair shares a filter, from the products of both with the directions of each part.

    Of a part, and of the sums over the parts so far, only choices matter that no other one equals or exceeds for both.
    """
    a, b = np.zeros(1), np.zeros(1)
    for x, y in products:
        for own in (True, False):
            if not own:
                x, y = (a[:, None] + x).ravel(), (b[:, None] + y).ravel()
            able = (x >= x[y.argmax()]) & (y >= y[x.argmax()])
            x, y = x[able], y[able]
            order = np.lexsort((-y, -x))
            x, y = x[order], y[order]
            first = np.concatenate(([True], y[1:] > np.maximum.accumulate(y)[:-1]))
            x, y = x[first], y[first]
        a, b = x, y
    return float(np.minimum(a, b).max())


@lru_cache(maxsize=64)
def limit_of(dim: int, parts: int, size: int, threshold: float, cosine: float) -> tuple[float, float]:
    """The inner product that a filter direction must be exceeded on, and of how many filters a random vector does.

    ``threshold`` / sqrt(dim), or lower where ``PAIRS`` random pairs at the limit show that more than 1 in five hundred
    of them would share no filter; so vectors whose products follow no normal law are found too, at any size.
    """
    books, plain = codes(dim, parts, size)[1], threshold / math.sqrt(dim)
    rng, best, kept = np.random.default_rng(dim), [], []
    for _ in range(PAIRS // 16):
        x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.standard_normal((2, 16, dim)))
        y -= (x * y).sum(axis=1, keepdims=True) * x
        n = np.linalg.norm(y, axis=1, keepdims=True)
        y = cosine * x + math.sqrt(1 - cosine**2) * np.divide(y, n, out=np.zeros_like(y), where=n > 0)
        products, at = [], 0
        for c in books:
            products.append([v[:, at : at + c.shape[1]] @ c.T for v in (x, y)])
            at += c.shape[1]
        best += [best_shared([(p[i], q[i]) for p, q in products]) for i in range(16)]
        if len(kept) < 64:
            kept += [[p[i] for p, _ in products] for i in range(16)]
    limit = min(plain, float(np.quantile(best, 0.002)))
    ends = [np.sort(v[-1]) for v in kept]
    heads = [v[0] if len(v) > 1 else np.zeros(1) for v in kept]
    return limit, float(np.mean([(size - np.searchsorted(e, limit - h)).sum() for e, h in zip(ends, heads, strict=True)]))


@lru_cache(maxsize=64)
def law_of(dim: int, n: int, cosine: float, shared: float) -> tuple[int, int, float]:
    """(parts, directions in each, limit) for the vectors of one length.

    In few dimensions directions crowd: codes are halved while that about halves the filters of a vector, so
    comparisons, which go by their square over the number of filters, hardly become more.
    """
    parts, size, threshold = plan(n, cosine, shared)
    limit, copies = limit_of(dim, parts, size, threshold, cosine)
    while size > 16:
        fewer = limit_of(dim, parts, size // 2, threshold, cosine)
        if 1.8 * fewer[1] > copies:
            break
        size, (limit, copies) = size // 2, fewer
    return parts, size, limit


def decode(unit: np.ndarray, parts: int, size: int, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) for all filters whose direction a unit row exceeds ``limit`` on; by row."""
    turn, books = codes(unit.shape[1], parts, size)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    step = max(16, (1 << 21) // size)
    for start in range(0, len(unit), step):
        turned, at, sums = unit[start : start + step] @ turn, 0, []
        for c in books:
            sums.append(turned[:, at : at + c.shape[1]] @ c.T)
            at += c.shape[1]
        best = [s.max(axis=1) for s in sums]
        n = len(turned)
        row, code, total = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
        for i, s in enumerate(sums):
            rest = sum(best[i + 1 :], np.zeros(n))
            k, j = np.nonzero(s >= (limit - rest - sum(best[:i], np.zeros(n)) - 1e-9)[:, None])
            value, begin = s[k, j], np.searchsorted(k, np.arange(n + 1))
            times = np.diff(begin)[row]
            ends, out, a = np.cumsum(times), [(row[:0], code[:0], total[:0])], 0
            while a < len(row):
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + (1 << 21), "right")))
                own = np.repeat(np.arange(a, b), times[a:b])
                pick = begin[row[own]] + np.arange(len(own)) - np.repeat(np.cumsum(times[a:b]) - times[a:b], times[a:b])
                more = total[own] + value[pick]
                reach = np.flatnonzero(more + rest[row[own]] >= limit)
                own = own[reach]
                out.append((row[own], code[own] * size + j[pick[reach]], more[reach]))
                a = b
            row, code, total = (np.concatenate(x) for x in zip(*out, strict=True))
        found.append((row + start, code))
    return np.concatenate([r for r, _ in found]), np.concatenate([c for _, c in found])


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


_ENTRY = "filter long, cls long, m long, vec binary"


def _decoded(kind: str, n: int, cosine: float, shared: float, whole: bool = True):
    """Entries (filter, cls, m, vec) of all filters of each vector, or with ``whole`` off the filters alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            dims = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)
            starts = np.concatenate(([0], np.cumsum(dims)))
            cls, m = batch.column("cls").to_numpy(), batch.column("m").to_numpy()
            for dim in np.unique(dims).tolist():
                law = law_of(dim, n, cosine, shared)
                for at in range(0, len(own := np.flatnonzero(dims == dim)), 1024):
                    rows = own[at : at + 1024]
                    x = flat[starts[rows][:, None] + np.arange(dim)]
                    row, code = decode(unit_rows(x), *law)
                    code += dim << 42
                    if not whole:
                        yield pa.RecordBatch.from_arrays([pa.array(code)], ["filter"])
                        continue
                    raw = [v.tobytes() for v in x]
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(cls[rows][row]), pa.array(m[rows][row]), pa.array([raw[r] for r in row.tolist()], pa.binary())], ["filter", "cls", "m", "vec"])

    return run


def _meet(cosine: float, law: tuple[int, int, float], filter_: int, ids: np.ndarray, m: np.ndarray, unit: np.ndarray, chunk: np.ndarray, tile: tuple[int, int]) -> list[tuple[int, int, int]]:
    """(cls, links counted here, cls of a row that it is connected with) for the rows of one filter or tile."""
    link = unit @ unit.T >= cosine
    np.fill_diagonal(link, False)
    if tile[0] != tile[1]:  # each tile counts the pairs across its chunks, a diagonal one those within its own
        link &= chunk[:, None] != chunk[None, :]
    some = np.flatnonzero(link.any(axis=1))
    if not len(some):
        return []
    link, ids, m = link[np.ix_(some, some)], ids[some], m[some]
    # Pairs that meet in a smaller filter too were counted there: the filters of linked rows are decoded again.
    row, code = decode(unit[some], *law)
    smaller = code + (unit.shape[1] << 42) < filter_
    row, code = row[smaller], code[smaller]
    _, column, rows = np.unique(code, return_inverse=True, return_counts=True)
    kept = rows[column] > 1
    before = np.zeros(link.shape, np.float32)
    if kept.any():
        row, column = row[kept], np.unique(column[kept], return_inverse=True)[1]
        for at in range(0, int(column.max()) + 1, 4096):
            inside = (column >= at) & (column < at + 4096)
            block = np.zeros((len(some), min(4096, int(column.max()) + 1 - at)), np.float32)
            block[row[inside], column[inside] - at] = 1
            before += block @ block.T
    counted = ((link & (before == 0)) * m[None, :]).sum(axis=1)
    label = np.arange(len(some))
    while True:
        new = np.minimum(np.where(link, label[None, :], len(some)).min(axis=1), label)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    return list(zip(ids.tolist(), counted.tolist(), ids[label].tolist(), strict=True))


def _verified(kind: str, n: int, cosine: float, shared: float):
    """Streams rows sorted by (filter, i, j) and works off each filter or tile as soon as it is whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
            key = np.stack([table.column(c).to_numpy() for c in ("filter", "i", "j")])
            ids, m, chunk = (table.column(c).to_numpy() for c in ("cls", "m", "chunk"))
            vec = table.column("vec").to_pylist()
            edges = np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0), [True])))
            out: list[tuple[int, int, int]] = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if b - a > 1:
                    unit = unit_rows(np.frombuffer(b"".join(vec[a:b]), kind).reshape(b - a, -1))
                    law = law_of(unit.shape[1], n, cosine, shared)
                    out += _meet(cosine, law, int(key[0, a]), ids[a:b], m[a:b], unit, chunk[a:b], (int(key[1, a]), int(key[2, a])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["cls", "links", "to"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("filter", "i", "j")])
            last = int(np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0))))[-1])
            if held and last == 0 and all(held[-1].column(c)[-1].as_py() == key[n, 0] for n, c in enumerate(("filter", "i", "j"))):
                held.append(batch)
                continue
            held.append(batch.slice(0, last))
            yield from work(pa.Table.from_batches(held))
            held = [batch.slice(last)]
        if held:
            yield from work(pa.Table.from_batches(held))

    return run


def comparable(v: Column) -> Column:
    """Whether a vector has a direction: no null, all finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, shared: float = SHARED) -> DataFrame:
    """A row for each row of ``vectors`` (vec_id, embedding, more): vec_id, n_links, component_id, kept.

    Rows whose embedding is null, empty or zero or holds null or non-finite components link with nothing.
    Only vectors of one length are compared.  Equal vectors link whatever their ids; repeated rows count each.
    A pair is found with a probability that falls with its distance, about 0.99 at the limit; none below the
    limit is reported.  Rows with a null vec_id take part, their own component_id may be null.
    """
    kind = "f4" if "float" in dict(vectors.dtypes)["embedding"] else "f8"
    element = "float" if kind == "f4" else "double"
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{element}>").alias("embedding"))
    source = source.withColumn("cls", F.when(comparable(F.col("embedding")), F.xxhash64(F.transform("embedding", lambda x: x + F.lit(0).cast(element)))))
    ids = stored(source.select("vec_id", "cls"), "ids")
    classes = stored(source.filter("cls is not null").groupBy("cls").agg(F.count(F.lit(1)).alias("m"), F.first("embedding").alias("embedding")), "classes")
    n = classes.count()
    entries = classes.mapInArrow(_decoded(kind, n, cosine, shared), _ENTRY)
    seen = classes.select("cls", "m", "embedding").mapInArrow(_decoded(kind, n, cosine, shared, False), "filter long")
    many = seen.groupBy("filter").count().filter(F.col("count") > 2 * CHUNK).select("filter", F.ceil(F.col("count") / CHUNK).cast("int").alias("q"))
    dealt = entries.join(many, "filter", "left").withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("cls"), "q"), F.lit(0)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.coalesce("q", F.lit(1)) - 1)).alias("o")
    tiles = dealt.select("filter", "cls", "m", "vec", "chunk", other).withColumns({"i": F.least("chunk", "o"), "j": F.greatest("chunk", "o")}).drop("o")
    met = stored(tiles.repartition("filter", "i", "j").sortWithinPartitions("filter", "i", "j").mapInArrow(_verified(kind, n, cosine, shared), "cls long, links long, to long"), "met")
    links = met.groupBy("cls").agg(F.sum("links").alias("links"))
    found = connected_components(met, "cls", "to").select(F.col("node").alias("cls"), F.col("component").alias("c"))
    size = ids.filter("cls is not null").groupBy("cls").agg(F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("least"))
    known = size.join(links, "cls", "left").join(found, "cls", "left").withColumn("c", F.coalesce("c", "cls"))
    least = known.groupBy("c").agg(F.min("least").alias("component_id"))
    known = known.join(least, "c").select("cls", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"), "component_id")
    own = ids.join(known, "cls", "left")
    component = F.coalesce("component_id", "vec_id")
    return own.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
