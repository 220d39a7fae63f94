"""Language-model scoring from a log-frequency Bloom filter.

Counts of pairs and triples of words are quantised on a logarithmic scale; an n-gram whose count has level q puts
the items (n-gram, 1) ... (n-gram, q) into a Bloom filter.  A count is read back by probing levels until one is
missing, so it can come out too high with a small probability and never too low by more than its level.

The filter is as large as the corpus asks for: ``ITEM_BITS`` for each item, no n-gram left out.  It is cut into
segments by hash block, each built by one task from the exact counts of its block.  The most frequent n-grams, as many
as fit ``HEAD_BITS``, are also in a head filter of that fixed size, which is broadcast; an n-gram that is not found
there is asked for in its block: the distinct ones of a slice of text travel to the segments, a byte for each travels
on to the compressed slice, which is scored.  Words keep exact counts, as the base score needs
them: those more frequent than one token in ``HEAD_WORDS`` are broadcast, the others are asked for in their blocks.

The score interpolates triples with pairs with add-one word probabilities.  What a context leaves to the shorter one
is worth count ** ``POWER`` + 1 observations: rare contexts lean on the shorter one, frequent ones much less.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreflow.llm.textblocks import combine, distinct, mix, slices, tidy, word_hashes, words
from acreflow.plans.storage import input_bytes, rows_keep_order, stored

#: Words that are broadcast with their exact counts, at most.
HEAD_WORDS = 1 << 18
#: Bits of the broadcast filter (16 MB), its bits and probes for an item, and its segments, each built by one task.
HEAD_BITS = 1 << 27
HEAD_ITEM_BITS, HEAD_PROBES = 24, 8
LOG2_HEAD_SEGMENTS = 6
#: Bits and probes for an item of a block's segment.
ITEM_BITS, PROBES = 12, 6
LEVEL_BASE = 1.5
POWER = 0.9
#: Bytes of input that one hash block stands for, as Catalyst estimates them.
BLOCK_BYTES = 4 << 20
#: Bytes of text that a task works on at once, and entries that it gathers before it sends them.
SLICE = 4 << 20
GATHERED = 4 << 20
#: Bits of a pair or triple that tell it apart in its block; two that share them add a small part to the filter's errors.
KEY_BITS = 32
WORD, PAIR, TRIPLE = 1, 2, 3
END = np.uint64(0x9D39247E33776D41)
START = np.uint64(0x2AF7398005AAA5C7)


def in_training(doc_id: int | None) -> bool:
    """Whether the model learns from a document; the others are held out.  A null id counts as empty text."""
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 7 != 2


def level(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log_base count)."""
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(LEVEL_BASE) + 1e-9).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    low = np.ceil(LEVEL_BASE ** (levels - 1.0) - 1e-9)
    high = np.ceil(LEVEL_BASE ** np.asarray(levels, float) - 1e-9) - 1
    return np.where(levels > 0, (low + np.maximum(low, high)) / 2, 0.0)


def _hash(keys: np.ndarray, q: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(keys + np.uint64(q) * np.uint64(0xD1342543DE82EF95))


def _spot(h: np.ndarray, i: int, size: int) -> np.ndarray:
    """The bit that probe ``i`` of hashed items looks at, of ``size`` < 2**32 bits."""
    low = np.uint64(0xFFFFFFFF)
    return (((h >> np.uint64(32)) + np.uint64(i) * ((h & low) | np.uint64(1))) & low) * np.uint64(size) >> np.uint64(32)


def build_filter(keys: np.ndarray, levels: np.ndarray, size: int, probes: int, first: int = 1) -> np.ndarray:
    """``size`` bits (a multiple of 8) as bytes, with the items (key, first) ... (key, level) of all keys."""
    bits = np.zeros(size, bool)
    for q in range(first, int(levels.max(initial=0)) + 1):
        h = _hash(keys[levels >= q], q)
        for i in range(probes):
            bits[_spot(h, i, size).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def probe(filter_: np.ndarray, keys: np.ndarray, size: int, probes: int, first: int = 1, base: np.ndarray | None = None) -> np.ndarray:
    """The level of each key, by probes until one fails; 0 if the first does.  ``base``: the bit where each key's filter begins."""
    out = np.zeros(len(keys), np.uint8)
    alive, q = np.arange(len(keys)), first
    while len(alive) and q < 256:
        h = _hash(keys[alive], q)
        for i in range(probes):
            at = _spot(h, i, size)
            if base is not None:
                at += base[alive]
            hit = (filter_[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0
            alive, h = alive[hit], h[hit]
        out[alive] = q
        q += 1
    return out


@dataclass(frozen=True)
class Blocks:
    """How 64-bit hashes are cut: a word is whole, a pair or triple ``KEY_BITS`` bits within its block."""

    bits: int

    @property
    def key_bits(self) -> int:
        return min(KEY_BITS, 64 - self.bits)

    def cut(self, kind: int, grams: np.ndarray) -> np.ndarray:
        """What stands for n-grams: block and key, or the whole hash of a word."""
        return grams if kind == WORD else grams >> np.uint64(64 - self.bits - self.key_bits)

    def of(self, kind: int, cut: np.ndarray) -> np.ndarray:
        return (cut >> np.uint64(64 - self.bits if kind == WORD else self.key_bits)).astype(np.int64)

    def runs(self, kind: int, cut: np.ndarray) -> list[tuple[int, int, int]]:
        """(block, start, end) of ascending entries."""
        if not len(cut):
            return []
        block = self.of(kind, cut)
        edges = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        return list(zip(block[edges].tolist(), edges.tolist(), np.append(edges[1:], len(block)).tolist(), strict=True))

    def pack(self, kind: int, cut: np.ndarray) -> bytes:
        """Ascending entries of one block: words whole, others as the steps between their keys, byte by byte, so that high ones, mostly 0, compress."""
        if kind == WORD:
            return cut.tobytes()
        key = (cut & np.uint64((1 << self.key_bits) - 1)).astype(np.uint32)
        return np.diff(key, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(kind: int, data: bytes) -> np.ndarray:
    if kind == WORD:
        return np.frombuffer(data, np.uint64)
    steps = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view(np.uint32)
    return np.cumsum(steps, dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    """A byte each; 255 stands for one of the longs that follow."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def _unpack_counts(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data[n:], np.int64)
    return out


def grams_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Where each text begins among all tokens, its end being one; and by kind the hashes of the token itself, of the
    pair and of the triple that it ends.  Before the first token are starts."""
    starts, ends, first = words(raw, offsets)
    tokens, n = word_hashes(raw, starts, ends), len(offsets) - 1
    every = np.full(len(tokens) + n, END)
    every[np.arange(len(tokens)) + np.repeat(np.arange(n), np.diff(first))] = tokens
    first = first + np.arange(n + 1)
    chain = np.empty((len(every), 3), np.uint64)
    chain[:, 2] = every
    for i in (1, 0):
        chain[1:, i] = chain[:-1, i + 1]
        chain[first[:-1], i] = START
    return first, {WORD: every, PAIR: combine(chain[:, 1:].reshape(-1), 2)[::2], TRIPLE: combine(chain.reshape(-1), 3)[::3]}


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending keys of (keys, counts) with the sums of their counts."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(counts, new) if len(new) else counts


_COUNTED = "kind int, block long, keys binary, counts binary"


def _count(blocks: Blocks):
    """The distinct words, pairs and triples of training text with their counts, by hash block."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {WORD: [], PAIR: [], TRIPLE: []}

        def sent() -> pa.RecordBatch:
            out = []
            for kind, parts in held.items():
                keys, counts = _merged(parts)
                parts.clear()
                out += [(kind, b, blocks.pack(kind, keys[i:j]), _pack_counts(counts[i:j])) for b, i, j in blocks.runs(kind, keys)]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["kind", "block", "keys", "counts"])

        n = 0
        for batch in batches:
            keep = pa.array([in_training(i) for i in batch.column("doc_id").to_pylist()], pa.bool_())
            for _, _, raw, offsets in slices(batch.column("text").filter(keep), SLICE):
                for kind, grams in grams_of(raw, offsets)[1].items():
                    held[kind].append(np.unique(blocks.cut(kind, grams), return_counts=True))
                    n += len(held[kind][-1][0])
                if n >= GATHERED:
                    yield sent()
                    n = 0
        if n:
            yield sent()

    return run


_SUMMED = "block long, words binary, word_counts binary, filter binary, head binary, head_levels binary, head_least int, histogram array<bigint>, n_distinct long, n_total long"
_KINDS = [pa.int64(), *[pa.binary()] * 5, pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int64()]


def _fitting(histogram: np.ndarray, room: float) -> int:
    """The least level whose n-grams, with items from that level on, fit into ``room`` items with all higher ones."""
    above = np.cumsum(histogram[::-1])[::-1]  # n-grams of a level or more: what one level of items takes
    q = len(histogram) - 1
    while q > 1 and above[q - 1 :].sum() <= room:
        q -= 1
    return q


def _sum_block(blocks: Blocks):
    """The exact word counts of a hash block, its segment of the filter, and its share of what could be in the head."""
    share = 1.25 * HEAD_BITS / HEAD_ITEM_BITS / (1 << blocks.bits) + 64

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block, parts = key[0].as_py(), {WORD: [], PAIR: [], TRIPLE: []}
        for kind, keys, counts in zip(*(table.column(c).to_pylist() for c in ("kind", "keys", "counts")), strict=True):
            keys = _unpack(kind, keys)
            parts[kind].append((keys, _unpack_counts(counts, len(keys))))
        own, total = _merged(parts[WORD])
        grams, counts = _merged(parts[PAIR] + parts[TRIPLE])
        q = level(counts)
        histogram = np.bincount(q, minlength=128)
        size = max(64, -(-int(q.sum()) * ITEM_BITS // 64) * 64)
        least = _fitting(histogram, share)
        head = q >= least
        whole = (np.uint64(block) << np.uint64(blocks.key_bits)) | grams[head]
        row = [block, own.tobytes(), total.tobytes(), build_filter(grams, q, size, PROBES).tobytes(), whole.tobytes(), q[head].astype(np.uint8).tobytes(), least, histogram.tolist(), len(own), int(total.sum())]
        return pa.table([pa.array([v], k) for v, k in zip(row, _KINDS, strict=True)], [f.split()[0] for f in _SUMMED.split(", ")])

    return run


def _head_items(blocks: Blocks, least: int):
    """The n-grams of the head, by the segment of its filter."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, levels in zip(batch.column("head").to_pylist(), batch.column("head_levels").to_pylist(), strict=True):
                keys, q = np.frombuffer(raw, np.uint64), np.frombuffer(levels, np.uint8)
                keys, q = keys[q >= least], q[q >= least]
                segment = (keys >> np.uint64(blocks.bits + blocks.key_bits - LOG2_HEAD_SEGMENTS)).astype(np.int64)
                out += [(s, keys[segment == s].tobytes(), q[segment == s].tobytes()) for s in np.unique(segment).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["segment", "keys", "levels"])

    return run


def _head_segment(least: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, q = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("keys", np.uint64), ("levels", np.uint8)))
        built = build_filter(keys, q.astype(np.int64), HEAD_BITS >> LOG2_HEAD_SEGMENTS, HEAD_PROBES, least)
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([built.tobytes()], pa.binary())], ["segment", "bits"])

    return run


def _frequent(least: float):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for raw, counts in zip(batch.column("words").to_pylist(), batch.column("word_counts").to_pylist(), strict=True):
                keys, c = np.frombuffer(raw, np.uint64), np.frombuffer(counts, np.int64)
                parts.append((keys[c > least].tobytes(), c[c > least].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in parts], pa.binary()) for i in range(2)], ["words", "word_counts"])

    return run


@dataclass(frozen=True)
class Model:
    """What is broadcast: frequent words with their counts, the head filter, and the size of the training text."""

    words: np.ndarray
    counts: np.ndarray
    head: np.ndarray
    least: int
    n_tokens: int
    n_distinct: int

    def known(self, blocks: Blocks, kind: int, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of a word or level of an n-gram, and which of them are not known here and have to be asked for."""
        if kind == WORD:
            at = np.searchsorted(self.words, cut)
            hit = at < len(self.words)
            hit[hit] = self.words[at[hit]] == cut[hit]
            out = np.zeros(len(cut), np.int64)
            out[hit] = self.counts[at[hit]]
            return out, ~hit
        size = 8 * len(self.head) >> LOG2_HEAD_SEGMENTS
        base = (cut >> np.uint64(blocks.bits + blocks.key_bits - LOG2_HEAD_SEGMENTS)) * np.uint64(size)
        out = probe(self.head, cut, size, HEAD_PROBES, self.least, base).astype(np.int64)
        return out, (out == 0) & (self.least > 1)


def train(docs: DataFrame, blocks: Blocks) -> tuple[Model, DataFrame]:
    """The model, and the table of blocks that answers for what it does not hold."""
    counted = docs.mapInArrow(_count(blocks), _COUNTED)
    table = stored(counted.groupBy("block").applyInArrow(_sum_block(blocks), _SUMMED), "blocks")
    n_distinct, n_tokens, found = table.agg(F.coalesce(F.sum("n_distinct"), F.lit(0)), F.coalesce(F.sum("n_total"), F.lit(0)), F.coalesce(F.max("head_least"), F.lit(1))).first()
    histogram = np.zeros(128, np.int64)
    for r in table.select(F.posexplode("histogram").alias("q", "n")).groupBy("q").agg(F.sum("n").alias("n")).collect():  # 128 rows
        histogram[r["q"]] = r["n"]
    least = max(_fitting(histogram, HEAD_BITS / HEAD_ITEM_BITS), found)
    head = np.zeros(HEAD_BITS // 8, np.uint8)
    size = len(head) >> LOG2_HEAD_SEGMENTS
    items = table.select("head", "head_levels").mapInArrow(_head_items(blocks, least), "segment long, keys binary, levels binary")
    for r in items.groupBy("segment").applyInArrow(_head_segment(least), "segment long, bits binary").toLocalIterator():
        head[r["segment"] * size : (r["segment"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    words_ = table.select("words", "word_counts").mapInArrow(_frequent(n_tokens / HEAD_WORDS), "words binary, word_counts binary").collect()  # fewer than HEAD_WORDS words
    keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["words"], np.uint64) for r in words_)])
    counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["word_counts"], np.int64) for r in words_)])
    order = np.argsort(keys)
    return Model(keys[order], counts[order], head, least, int(n_tokens), int(n_distinct)), table


#: Distinct n-grams of a slice in a block, or the answer; kind 0: what a slice's text sums up to.
_MAIL = "slice long, kind int, block long, data binary"
_MAIL_NAMES = [f.split()[0] for f in _MAIL.split(", ")]
_MAIL_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]


def _mail(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_MAIL_KINDS)], _MAIL_NAMES)


def _numbered(batches: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(number, rows, bytes, offsets) of the slices of a partition."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for at, stop, raw, offsets in slices(batch.column("text"), slice_bytes):
            yield number, batch.slice(at, stop - at), raw, offsets
            number += 1


def _packed(slice_bytes: int):
    """The slices themselves: compressed text, and of its rows the ids, lengths and which ids are null."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows, raw, offsets in _numbered(batches, slice_bytes):
            ids, null = rows.column("doc_id").fill_null(0).to_numpy(), rows.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            more = ids.astype(np.int64).tobytes() + np.diff(offsets).astype(np.int64).tobytes() + null.astype(np.uint8).tobytes()
            text = pa.compress(raw.tobytes(), codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([text], pa.binary()), pa.array([more + len(raw).to_bytes(8, "little")], pa.binary())], ["slice", "text", "rows"])

    return run


def _ask(shared, blocks: Blocks, slice_bytes: int):
    """By block what the model does not know of each slice, and what the slice's text sums up to."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, raw, offsets in _numbered(batches, slice_bytes):
            home = int(mix(np.array([number], np.uint64))[0] >> np.uint64(64 - blocks.bits))
            out = [(number, 0, home, zlib.crc32(raw.tobytes()).to_bytes(8, "little"))]
            for kind, grams in grams_of(raw, offsets)[1].items():
                own = distinct(blocks.cut(kind, grams))
                own = own[shared.value.known(blocks, kind, own)[1]]
                out += [(number, kind, b, blocks.pack(kind, own[i:j])) for b, i, j in blocks.runs(kind, own)]
            yield _mail(out)

    return run


def _answer(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """What a block knows of the n-grams that slices ask for: counts of words, levels of others.  Sums pass through."""
    block = right.to_pylist()[0] if right.num_rows else None
    kinds, data = left.column("kind").to_pylist(), left.column("data").to_pylist()
    for kind in (WORD, PAIR, TRIPLE):
        rows = [i for i, k in enumerate(kinds) if k == kind]
        if not rows:
            continue
        keys = [_unpack(kind, data[i]) for i in rows]
        ends, all_ = np.cumsum([len(k) for k in keys]), np.concatenate(keys)
        found = np.zeros(len(all_), np.uint32 if kind == WORD else np.uint8)
        if block and kind == WORD:
            own, counts = np.frombuffer(block["words"], np.uint64), np.frombuffer(block["word_counts"], np.int64)
            at = np.minimum(np.searchsorted(own, all_), max(len(own) - 1, 0))
            if len(own):
                found = np.where(own[at] == all_, counts[at], 0).astype(np.uint32)
        elif block:
            filter_ = np.frombuffer(block["filter"], np.uint8)
            found = probe(filter_, all_, 8 * len(filter_), PROBES)
        for i, a, b in zip(rows, np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
            data[i] = found[a:b].tobytes()
    return left.set_column(left.schema.get_field_index("data"), "data", pa.array(data, pa.binary()))


def log_probabilities(first: np.ndarray, single: np.ndarray, pair: np.ndarray, triple: np.ndarray, n_ends: float, n_tokens: int, n_distinct: int) -> np.ndarray:
    """The log10 probability of each token, from the counts of the word, pair and triple that end there."""
    before = np.append(n_ends, single[:-1])
    two = np.append(n_ends, pair[:-1])
    before[first[:-1]] = two[first[:-1]] = n_ends  # as many texts begin as end
    pair = np.minimum(np.minimum(pair, before), single)
    triple = np.minimum(np.minimum(triple, two), pair)
    p = (single + 1.0) / (n_tokens + n_distinct + 1)
    for seen, context in ((pair, before), (triple, two)):
        rest = context**POWER + 1
        p = (seen + rest * p) / (context + rest)
    return np.log10(p)


_SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score(shared, blocks: Blocks):
    def run(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        model, answers = shared.value, {0: [], WORD: [], PAIR: [], TRIPLE: []}
        for kind, block, data in zip(*(left.column(c).to_pylist() for c in ("kind", "block", "data")), strict=True):
            answers[kind].append((block, data))
        more = right.column("rows")[0].as_py() if right.num_rows else bytes(8)
        n = (len(more) - 8) // 17
        ids, lengths, null = np.frombuffer(more, np.int64, n), np.frombuffer(more, np.int64, n, 8 * n), np.frombuffer(more, np.uint8, n, 16 * n)
        raw = pa.decompress(right.column("text")[0].as_py(), int.from_bytes(more[-8:], "little"), codec="zstd", asbytes=True) if n else b""
        if [d for _, d in answers[0]] != [zlib.crc32(raw).to_bytes(8, "little")]:
            raise RuntimeError("a slice was cut differently when it was read again")
        raw = np.frombuffer(raw, np.uint8)
        first, grams = grams_of(raw, np.append(0, np.cumsum(lengths)))
        counts = {}
        for kind in (WORD, PAIR, TRIPLE):
            own, inverse = np.unique(blocks.cut(kind, grams.pop(kind)), return_inverse=True)
            value, missing = model.known(blocks, kind, own)
            got = np.frombuffer(b"".join(d for _, d in sorted(answers.pop(kind))), np.uint32 if kind == WORD else np.uint8)
            value[missing] = got
            if kind == WORD:
                n_ends = float(value[np.searchsorted(own, END)]) if n else 0.0
            counts[kind] = (value if kind == WORD else count_of(value))[inverse].astype(float)
        doc = np.repeat(np.arange(n), np.diff(first))
        logs = log_probabilities(first, counts[WORD], counts[PAIR], counts[TRIPLE], n_ends, model.n_tokens, model.n_distinct)
        base = np.log10(counts[WORD] + 1) - np.log10(model.n_tokens + model.n_distinct + 1)
        known = np.bincount(doc, counts[WORD] > 0, minlength=n).astype(np.int64)
        sums = [pa.array(np.bincount(doc, x, minlength=n)) for x in (base, logs)]
        return pa.table([pa.array(ids, mask=null > 0), pa.array(np.diff(first)), pa.array(known), *sums], [f.split()[0] for f in _SCORED.split(", ")])

    return run


def score_documents(docs: DataFrame, block_bits: int | None = None) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text, more): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    The model learns from the rows for which ``in_training``.  Words are lower-cased (A-Z) and separated by
    ASCII white space, one end token follows each text; null text is empty and has the end alone.  base_score
    is add-one unigram over exact counts; score is the model's.  Repeated rows count each in training and come back as
    often.  With nothing to learn from, all counts are 0.  Very long texts are a slice of their own.  Other
    columns are ignored.  ``block_bits``: hash blocks as a power of two, by the size of the input if not given.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not rows_keep_order(source):  # slices are cut twice, the same way
        source = stored(source, "source")
    blocks = Blocks(max(LOG2_HEAD_SEGMENTS, block_bits or (input_bytes(docs) // BLOCK_BYTES).bit_length()))
    model, table = train(source, blocks)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A slice is larger where there are many blocks, so that what it asks of one is not too little.
    slice_bytes = SLICE << min(2, max(0, blocks.bits - 14))
    asked = source.mapInArrow(_ask(shared, blocks, slice_bytes), _MAIL)
    exact = table.select(F.col("block").alias("b"), "words", "word_counts", "filter")
    answered = asked.groupBy("block").cogroup(exact.groupBy("b")).applyInArrow(_answer, _MAIL)
    texts = source.mapInArrow(_packed(slice_bytes), "slice long, text binary, rows binary")
    scored = answered.groupBy("slice").cogroup(texts.groupBy("slice")).applyInArrow(_score(shared, blocks), _SCORED)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
