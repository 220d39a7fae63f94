"""N-gram Jaccard join by a blocked sparse matrix product.

The incidence matrix A has a row for each distinct shingle set and a column for each 5-word shingle.
A·Aᵀ holds all overlaps, but only entries with 9·overlap >= 4·(|a|+|b|) (Jaccard >= 0.8) matter, so sizes
bound what has to be multiplied:

* A is dealt into tiles (row chunk × column block, 5 bytes an entry).  A column block counts how many rows
  each of its columns has; columns of one row cannot overlap with anything and end there.
* A row that keeps fewer than ceil(0.8·n) entries cannot reach the bound and is dropped (most rows).
* With columns in ascending order of rows, a linked pair meets within the first n - ceil(0.8·n) + 1
  columns of both rows.  Only these prefixes are multiplied; passages that many documents share are at the
  far end of the order.
* The product runs twice.  First each row goes only against the most central row of its columns (the one
  whose columns have most rows); exact checks make links and components of them, so a group of near copies
  costs as much as it has rows.  Then prefixes are multiplied between different components only; a pair
  within one component could not change any component, so nothing is lost.  In columns of few rows, overlap
  counts are accumulated by pair, pairs whose count and remaining size stay below the bound are discarded,
  the others are checked exactly.  Columns of many rows that are still in different components (near copies
  that are too far from each other) are joined into clusters, and a cluster's rows are multiplied in dense
  tiles of bounded size, of which only a spanning set of links comes out, never the pairs.

Rows are distinct shingle sets (64-bit identities): exact copies are collapsed, inside a task before the
shuffle and then in each block, and come back by a join.  A column block gathers the entries of its columns.
Shingles that a bounded sample of sets shows to be in many of them are not counted, so no task gathers them: they
are sent to the blocks of their rows right away, as columns of most rows, last in the order.  Which ones the sample
shows only moves work, any order of columns gives the same links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreflow.llm.textblocks import distinct, mix, shingle_sets, slices, tidy, word_hashes, words
from acreflow.operators.components import connected_components
from acreflow.plans.storage import forget, input_bytes, stored

WIDTH = 5
#: Bytes of input that one column block stands for, as Catalyst estimates them.
BLOCK_BYTES = 8 << 20
#: Columns of more rows than this are multiplied in tiles.
FEW = 16
#: Sets in the sample that hot shingles are looked for in, about; in how many of them a hot one is; and how many there are at most.
SAMPLE_SETS, HOT_SETS, HOT = 4096, 40, 1 << 16
MOST_ROWS = 65535
#: Rows in a chunk of a cluster, at least and at most; a tile is made of two chunks.
CHUNK = (128, 1500)
_SEED = np.uint64(0xD6E8FEB86659FD93)


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit identity of a set of shingle hashes."""
    with np.errstate(over="ignore"):
        total = mix(shingles ^ _SEED).sum(dtype=np.uint64) + np.uint64(len(shingles))
        return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def least_kept(n: np.ndarray | int) -> np.ndarray | int:
    """ceil(0.8 n): what a row of n shingles must share with any row it links to."""
    return (4 * n + 4) // 5


def linked(overlap: int, n_a: int, n_b: int) -> bool:
    """100 * intersection >= 80 * union, in integers."""
    return 9 * overlap >= 4 * (n_a + n_b)


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    for _, _, raw, offsets in slices(column):
        starts, ends, first = words(raw, offsets)
        yield from shingle_sets(word_hashes(raw, starts, ends), first, width)


def _identities(width: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = [], []
            for s in _sets(batch.column("text"), width):
                ids.append(set_id(s))
                sizes.append(len(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "set_id", "n"]
            )

    return run


#: Entries of a column block, or of the row block -1 - ``block``, whose columns are hot.
_TILE = "block long, ids binary, counts binary, sizes binary, low binary, high binary, at binary"
_TURNED = "block long, ids binary, counts binary, sizes binary, low binary, high binary, at binary, rows binary"
_NAMES = [f.split()[0] for f in _TURNED.split(", ")]


def _bytes(a: np.ndarray, kind: type) -> bytes:
    return a.astype(kind).tobytes()


def _key_bits(bits: int) -> int:
    """Bits of a shingle's hash that tell it apart in its column block."""
    return min(40, 64 - bits)


def _runs(ascending: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, start, end) of runs of equal values."""
    if not len(ascending):
        return []
    edges = np.flatnonzero(np.concatenate(([True], ascending[1:] != ascending[:-1])))
    return list(zip(ascending[edges].tolist(), edges.tolist(), np.append(edges[1:], len(ascending)).tolist(), strict=True))


def _tiles(width: int, bits: int, hot: np.ndarray):
    """Row chunks of A, cut into column blocks (the top ``bits`` of a shingle's hash); hot columns into row blocks."""
    key_bits = np.uint64(_key_bits(bits))

    def cut(block: np.ndarray, column: np.ndarray, row: np.ndarray, ids: np.ndarray, sizes: np.ndarray, with_at: bool) -> list[tuple]:
        order = np.argsort(block, kind="stable")
        block, column, row, out = block[order], column[order], row[order], []
        key, at = column & ((np.uint64(1) << key_bits) - np.uint64(1)), column >> key_bits
        for b, i, j in _runs(block):
            edges = np.flatnonzero(np.concatenate(([True], row[i + 1 : j] != row[i : j - 1], [True])))
            have, k = row[i:j][edges[:-1]], key[i:j]
            out.append((b, ids[have].tobytes(), _bytes(np.diff(edges), np.uint32), _bytes(sizes[have], np.uint32), _bytes(k, np.uint32), _bytes(k >> np.uint64(32), np.uint8), _bytes(at[i:j], np.uint32) if with_at else None))
        return out

    def tile(sets: list[np.ndarray], ids: list[int]) -> pa.RecordBatch:
        sizes, ids_ = np.array([len(s) for s in sets], np.int64), np.array(ids, np.int64)
        entries = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), sizes)
        is_hot = np.zeros(len(entries), bool)
        if len(hot):
            is_hot = hot[np.minimum(np.searchsorted(hot, entries), len(hot) - 1)] == entries
        column = entries >> np.uint64(64 - bits - int(key_bits))
        plain = ~is_hot
        out = cut((entries[plain] >> np.uint64(64 - bits)).astype(np.int64), column[plain], row[plain], ids_, sizes, False)
        home = -1 - (ids_.view(np.uint64)[row[is_hot]] >> np.uint64(64 - bits)).astype(np.int64)
        out += cut(home, column[is_hot], row[is_hot], ids_, sizes, True)
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64() if not i else pa.binary()) for i in range(7)], _NAMES[:7])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sets, ids, held = [], [], 0
            for s in _sets(batch.column("text"), width):
                if len(s) and (i := set_id(s)) not in seen:
                    seen.add(i)
                    sets.append(s)
                    ids.append(i)
                    held += len(s)
                if held > 1 << 20:
                    yield tile(sets, ids)
                    sets, ids, held = [], [], 0
            if sets:
                yield tile(sets, ids)
            if len(seen) > 1 << 20:  # only saves shuffle: a block drops repeated rows anyway
                seen.clear()

    return run


def _sample_shingles(width: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in _sets(batch.column("text"), width):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), set_id(s))), pa.array(s.view(np.int64))], ["s", "shingle"])

    return run


def hot_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Hashes of shingles that are in at least ``HOT_SETS`` different sets of a sample: the most frequent ``HOT``, ascending."""
    n = docs.count()
    some = docs.select("text").sample(False, min(1.0, SAMPLE_SETS / max(n, 1)), 7)
    counted = some.mapInArrow(_sample_shingles(width), "s long, shingle long").distinct().groupBy("shingle").count().filter(F.col("count") >= HOT_SETS)
    found = counted.orderBy(F.desc("count"), "shingle").limit(HOT).collect()
    return np.sort(np.array([r["shingle"] for r in found], np.int64).view(np.uint64))


def _gather(table: pa.Table, name: str, kind: type) -> np.ndarray:
    parts = [np.frombuffer(x.as_py(), kind) for x in table.column(name)]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of tiles: the distinct row ids (as uint64, ascending), their sizes, and each entry's row."""
    ids, at, inverse = np.unique(_gather(table, "ids", np.int64).view(np.uint64), return_index=True, return_inverse=True)
    return ids, _gather(table, "sizes", np.uint32)[at], np.repeat(inverse, _gather(table, "counts", np.uint32))


def _key(table: pa.Table) -> np.ndarray:
    return _gather(table, "low", np.uint32).astype(np.uint64) | (_gather(table, "high", np.uint8).astype(np.uint64) << np.uint64(32))


def _turned(block: np.ndarray, ids: np.ndarray, sizes: np.ndarray, row: np.ndarray, key: np.ndarray, at: np.ndarray, n_rows: np.ndarray) -> pa.Table:
    """Entries, by row, cut into row blocks; ``block`` is that of each row."""
    out = []
    for b, i, j in _runs(block[row]):
        edges = np.flatnonzero(np.concatenate(([True], row[i + 1 : j] != row[i : j - 1], [True])))
        have, k = row[i:j][edges[:-1]], key[i:j]
        out.append((b, ids[have].tobytes(), _bytes(np.diff(edges), np.uint32), _bytes(sizes[have], np.uint32), _bytes(k, np.uint32), _bytes(k >> np.uint64(32), np.uint8), _bytes(at[i:j], np.uint32), _bytes(n_rows[i:j], np.uint16)))
    return pa.table([pa.array([x[i] for x in out], pa.int64() if not i else pa.binary()) for i in range(8)], _NAMES)


def _count_columns(bits: int):
    """A column block: entries of columns with two rows or more, turned to row blocks, with the rows counted.
    Hot columns, which come by the blocks of their rows, count as of most rows."""

    def run(group: tuple, table: pa.Table) -> pa.Table:
        block = group[0].as_py()
        ids, sizes, row = _rows(table)
        key = _key(table)
        home = (ids >> np.uint64(64 - bits)).astype(np.int64)
        if block < 0:
            at = _gather(table, "at", np.uint32)
            order = np.lexsort((key, at, row))
            key, at, row = key[order], at[order], row[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (at[1:] != at[:-1]) | (row[1:] != row[:-1])))
            return _turned(home, ids, sizes, row[new], key[new], at[new], np.full(int(new.sum()), MOST_ROWS))
        if len(ids) <= 1 << 24:
            packed = distinct((key << np.uint64(24)) | row.astype(np.uint64))
            key, row = packed >> np.uint64(24), (packed & np.uint64((1 << 24) - 1)).astype(np.int64)
        else:
            order = np.lexsort((row, key))
            key, row = key[order], row[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])))
            key, row = key[new], row[new]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        n_rows = np.diff(np.append(start, len(key)))
        n_rows = np.repeat(n_rows, n_rows)
        kept = n_rows > 1
        key, row, n_rows = key[kept], row[kept], np.minimum(n_rows[kept], MOST_ROWS)
        order = np.argsort(row, kind="stable")
        return _turned(home, ids, sizes, row[order], key[order], np.full(len(key), block), n_rows[order])

    return run


def _rare_first(bits: int):
    """A row block: rows that keep at least ceil(0.8 n) entries, their columns in the order of rarity."""

    def run(table: pa.Table) -> pa.Table:
        ids, sizes, row = _rows(table)
        column = _key(table) | (_gather(table, "at", np.uint32).astype(np.uint64) << np.uint64(_key_bits(bits)))
        rare = _gather(table, "rows", np.uint16)
        alive = np.bincount(row, minlength=len(ids)) >= least_kept(sizes.astype(np.int64))
        kept = alive[row]
        column, rare, row = column[kept], rare[kept], row[kept]
        order = np.lexsort((column, rare, row))
        column, row = column[order].view(np.int64), row[order]
        have = np.flatnonzero(alive)
        cuts = np.searchsorted(row, np.append(have, len(ids)))
        keys = [column[i:j].tobytes() for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        central = np.bincount(row, rare[order], minlength=len(ids))[have].astype(np.int64)
        return pa.table([pa.array(ids[have].view(np.int64)), pa.array(sizes[have].astype(np.int64)), pa.array(central), pa.array(keys, pa.binary())], ["set_id", "n", "central", "keys"])

    return run


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        sizes = batch.column("n").to_numpy()
        for keys, need in zip(batch.column("keys"), least_kept(sizes).tolist(), strict=True):
            k = np.frombuffer(keys.as_py(), np.int64)
            parts.append(k[: len(k) - need + 1])
        count = [len(p) for p in parts]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        own = [pa.array(np.repeat(batch.column(c).to_numpy(), count)) for c in ("set_id", "n", "central")]
        yield pa.RecordBatch.from_arrays([pa.array(flat), *own], ["key", "s", "n", "central"])


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that link, by their whole rows."""
    for batch in batches:
        keep = []
        for a, b, n, m in zip(batch.column("keys_a"), batch.column("keys_b"), batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist(), strict=True):
            both = np.sort(np.concatenate((np.frombuffer(a.as_py(), np.int64), np.frombuffer(b.as_py(), np.int64))))
            keep.append(linked(int((both[1:] == both[:-1]).sum()), n, m))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _links(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    end = lambda x: rows.select(F.col("set_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("keys").alias(f"keys_{x}"))
    return pairs.select("a", "b").join(end("a"), "a").join(end("b"), "b").select("a", "b", "n_a", "n_b", "keys_a", "keys_b").mapInArrow(_check, "a long, b long")


def _tile_links(key: tuple, table: pa.Table) -> pa.Table:
    """Of the rows of one tile: edges that span all links between rows of different components."""
    ids, sizes = table.column("s").to_numpy(), table.column("n").to_numpy()
    parts = [np.frombuffer(k.as_py(), np.int64) for k in table.column("keys")]
    row = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    _, column, n_rows = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    kept = n_rows[column] > 1
    row, column = row[kept], np.unique(column[kept], return_inverse=True)[1]
    overlap = np.zeros((len(ids), len(ids)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        i, j = np.searchsorted(column, (at, at + 2048))
        block = np.zeros((len(ids), 2048), np.float32)
        block[row[i:j], column[i:j] - at] = 1
        overlap += block @ block.T
    link = 9 * overlap >= 4 * (sizes[:, None] + sizes[None, :]).astype(np.float32)
    label = np.arange(len(ids))
    while True:
        new = np.where(link, label[None, :], len(ids)).min(axis=1)
        new = np.minimum(new, label)[np.minimum(new, label)]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(ids))
    return pa.table([pa.array(ids[far]), pa.array(ids[label[far]])], ["a", "b"])


def _cluster_links(hot: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b) links between the rows of columns with many rows, by clusters of such columns."""
    least = hot.groupBy("key").agg(F.min("c").alias("low"))
    joined = connected_components(hot.join(least, "key").select("c", "low").distinct(), "c", "low")
    members = hot.select("s", "n", "c").distinct().join(joined.select(F.col("node").alias("c"), F.col("component").alias("cluster")), "c")
    sized = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"))
    chunk = F.least(F.greatest(F.floor(F.col("m") / 32), F.lit(CHUNK[0])), F.lit(CHUNK[1]))
    chunks = sized.select("cluster", F.ceil(F.col("m") / chunk).cast("int").alias("q"))
    dealt = members.join(chunks, "cluster").withColumn("i", F.pmod(F.xxhash64("s"), "q").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("o")
    tiles = dealt.select("s", "n", "cluster", "i", other).select("s", "n", "cluster", F.least("i", "o").alias("i"), F.greatest("i", "o").alias("j"))
    own = tiles.join(rows.select(F.col("set_id").alias("s"), "keys"), "s")
    return own.groupBy("cluster", "i", "j").applyInArrow(_tile_links, "a long, b long")


def shingle_rows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, set_id, n) for each row of ``docs``: the identity and size of its shingle set."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_identities(width), "doc_id long, set_id long, n long")


def set_components(docs: DataFrame, width: int = WIDTH, block_bits: int | None = None) -> DataFrame:
    """(set_id, component) of the shingle sets that link with another one.  ``block_bits``: blocks as a power of two, by
    the size of the input if not given."""
    bits = min(32, max(4, block_bits or (input_bytes(docs) // BLOCK_BYTES).bit_length()))
    tiles = docs.select("text").mapInArrow(_tiles(width, bits, hot_shingles(docs, width)), _TILE)
    turned = tiles.groupBy("block").applyInArrow(_count_columns(bits), _TURNED)
    rows = stored(turned.groupBy("block").applyInArrow(_rare_first(bits), "set_id long, n long, central long, keys binary"), "rows")
    prefix = stored(rows.mapInArrow(_prefixes, "key long, s long, n long, central long"), "prefixes")
    # A row against the most central row of like size in each of its columns; the one it meets most often.
    graded = prefix.withColumn("grade", F.floor(F.log("n") / F.log(F.lit(1.25))))
    centre = graded.groupBy("key", "grade").agg(F.max(F.struct("central", "s")).alias("x")).select("key", "grade", F.col("x.s").alias("b"))
    votes = graded.join(centre, ["key", "grade"]).filter("s != b").groupBy("s", "b").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("s").agg(F.max(F.struct("votes", "b")).alias("x")).select(F.col("s").alias("a"), F.col("x.b").alias("b"))
    first = stored(_links(best, rows), "first")
    known = connected_components(first, "a", "b").select(F.col("node").alias("s"), F.col("component").alias("c"))
    # The product between different components.
    part = prefix.join(known, "s", "left").select("key", "s", "n", F.coalesce("c", "s").alias("c"))
    mixed = part.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("rows")).filter("lo < hi")
    part = stored(part.join(mixed.select("key", "rows"), "key"), "mixed")
    few = part.filter(F.col("rows") <= FEW)
    left = few.select("key", F.col("c").alias("ca"), F.col("s").alias("a"), F.col("n").alias("na"))
    right = few.select("key", F.col("c").alias("cb"), F.col("s").alias("b"), F.col("n").alias("nb"))
    pairs = left.join(right, "key").filter("ca < cb and 4 * na <= 5 * nb and 4 * nb <= 5 * na")
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    # Columns of many rows are left out of ``met``, so a pair is discarded only if it could meet in none of them.
    hot = part.filter(F.col("rows") > FEW)
    in_hot = hot.groupBy("s").agg(F.count(F.lit(1)).alias("h"))
    unseen = lambda x: in_hot.select(F.col("s").alias(x), F.col("h").alias(f"h_{x}"))
    counted = counted.join(unseen("a"), "a", "left").join(unseen("b"), "b", "left").withColumn("met", F.col("met") + F.coalesce(F.least("h_a", "h_b"), F.lit(0)))
    able = counted.filter("9 * (met + floor((4 * greatest(na, nb) + 4) / 5) - 1) >= 4 * (na + nb)")
    second = stored(_links(able, rows).unionByName(_cluster_links(hot, rows)), "second")
    out = connected_components(first.unionByName(second), "a", "b").withColumnRenamed("node", "set_id")
    forget(rows, prefix, first, part, second)  # components are checkpointed
    return out


def jaccard_components(docs: DataFrame, width: int = WIDTH, block_bits: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of ``docs`` (doc_id, text, more).

    Documents link at a Jaccard similarity of 0.8 or more of their distinct ``width``-word shingles.
    component_id is the smallest doc_id reachable by links, the row's own included.  Null or empty text and
    text of white space only: no shingle, linked with nothing, its own component.  Repeated rows are exact
    copies and link.  Rows with a null doc_id take part; such a row has the component of those it links
    with, or null.  Other columns are ignored.
    """
    ids = stored(shingle_rows(docs, width), "ids")
    found = set_components(docs, width, block_bits)
    own = ids.join(found, "set_id", "left").select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("component", "set_id")).alias("c"))
    least = own.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("least"))
    return own.join(least, "c", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each near-duplicate group does: the one whose
    doc_id is the group's smallest.  Rows with no shingle or a null doc_id stay; of rows with equal doc_id
    and text one stays."""
    kept = jaccard_components(docs, width).filter("doc_id = component_id").select("doc_id").distinct()
    own = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return own.select(docs.columns).unionByName(docs.filter("doc_id is null"))


#: The same by DuckDB, with every pair of different texts that share a shingle.
ORACLE_SQL = r"""
WITH RECURSIVE own AS (SELECT min(doc_id) AS k, coalesce(text, '') AS t FROM documents GROUP BY ALL),
w AS (SELECT k, list_filter(regexp_split_to_array(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM own),
s AS (SELECT k, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w WHERE len(w) > 0),
x AS (SELECT k, len(g) AS n, unnest(g) AS g FROM s),
links AS (SELECT a.k AS a, b.k AS b FROM x a JOIN x b ON a.g = b.g AND a.k < b.k GROUP BY a.k, b.k, a.n, b.n HAVING 180 * count(*) >= 80 * (a.n + b.n)),
e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
r AS (SELECT k AS n, k AS root FROM own UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.n),
c AS (SELECT n, min(root) AS component_id FROM r GROUP BY n)
SELECT d.doc_id, CAST(coalesce(len(s.g), 0) AS BIGINT) AS n_shingles, CASE WHEN s.g IS NULL THEN d.doc_id ELSE c.component_id END AS component_id
FROM documents d JOIN own ON own.t = coalesce(d.text, '') JOIN c ON c.n = own.k LEFT JOIN s ON s.k = own.k
"""
