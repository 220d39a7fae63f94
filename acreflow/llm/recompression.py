"""Removal of repeated passages by recompression.

A text is a string of words.  Each round first names runs (a symbol repeated k times becomes one) and then pairs: symbols
are dealt into left and right ones by a bit of their name, and a left one followed by a right one becomes one symbol.
Names are hashes of what they stand for, so all documents agree on them and no round needs an exchange.  Of every symbol the
words that decide it are known, itself and what its neighbours had to be: equal passages hold the same symbols, but for
those that words outside have a say in, near their ends.

A window of ``WINDOW`` words is *stood for* by the symbol of the highest level that the window alone decides, the first of
these.  In a first exchange such symbols, with the words that decide them, are counted; windows whose symbol occurs nowhere
else are unique.  In a second one the others are compared as wholes (96 bits of their words' 64-bit hashes) and all but the
earliest are given back.  Of documents that are equal as wholes all but the first are known by then and take no part.

Whatever a document sends is packed by slices of text and blocks of hashes; slices are stored once, so each pass cuts
them the same way, and each is small, except where one text is larger.  Equal windows of a slice travel once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreflow.llm import textblocks
from acreflow.llm.textblocks import mix, slices, tidy
from acreflow.plans.storage import input_bytes, stored

#: Words of a window.
WINDOW = 20
#: Rounds of naming; symbols of later ones are mostly decided by more words than a window has.
ROUNDS = 4
#: Bytes of text in a slice, and of input for a block of hashes.
SLICE, BLOCK_BYTES = 4 << 20, 16 << 20
#: Words that are named at once; windows are cut among pieces so that each is whole in one.
PIECE = 1 << 19

SYMBOL, TEXT, RANGE, LATER, COPY = range(5)
_MAIL = "slice long, kind int, block long, data binary"
_NAMES, _TYPES = [f.split()[0] for f in _MAIL.split(", ")], [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
_A, _B, _C = (np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_RUN = np.uint64(0xE7037ED1A0B428DB)


def _mail(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], _NAMES)


def exact_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words as they are, upper and lower case told apart."""
    return textblocks.word_hashes(raw, starts, ends, fold=False)


def levels(names: np.ndarray, edge: np.ndarray, rounds: int = ROUNDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(name, low, high) of the symbols after 0, 1 ... rounds; ``edge`` marks words that begin a document.

    The words from low up to high decide a symbol.  Where that would take words beyond a document's ends, low or high lies one
    beyond them, so no window reaches it.  Both never fall along the symbols of a level.
    """
    low = np.arange(len(names))
    high = low + 1
    yield names, low, high
    # A document's first and last symbol at any level begin and end with it.
    heads, edge = np.flatnonzero(edge), edge.copy()
    ends = np.append(heads[1:], len(names))
    for r in range(rounds if len(names) else 0):
        # Runs: whether a symbol is a whole run its neighbours decide.
        new = np.ones(len(names), bool)
        new[1:] = (names[1:] != names[:-1]) | edge[1:]
        first = np.flatnonzero(new)
        after = np.append(first[1:], len(names))
        edge, times = edge[first], after - first
        last = np.append(edge[1:], True)
        with np.errstate(over="ignore"):
            names = np.where(times > 1, mix(names[first] * _RUN + times.astype(np.uint64)), names[first])
        low, high = low[np.maximum(first - 1, 0)], high[np.minimum(after, len(high) - 1)]
        low[edge], high[last] = heads - 1, ends + 1
        # Pairs of a left and a right symbol.  A right one alone: no left one before it.  A left one alone: no right one behind it.
        with np.errstate(over="ignore"):
            right = (mix(names + np.uint64(r + 1) * _C) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(names), bool)
        joins[:-1] = ~right[:-1] & right[1:] & ~edge[1:]
        at = np.flatnonzero(~np.append(False, joins[:-1]))
        next_, before, pair = np.minimum(at + 1, len(names) - 1), np.maximum(at - 1, 0), joins[at]
        with np.errstate(over="ignore"):
            merged = np.where(pair, mix(names[at] * _A + names[next_] * _B + np.uint64(r)), names[at])
        low_, high_ = np.where(pair | ~right[at], low[at], low[before]), np.where(pair | ~right[at], high[next_], high[at])
        alone = ~pair
        low_[alone & right[at] & edge[at]] = heads[(np.cumsum(edge) - 1)[at[alone & right[at] & edge[at]]]] - 1
        closing = alone & ~right[at] & last[at]
        high_[closing] = ends[(np.cumsum(edge) - 1)[at[closing]]] + 1
        names, low, high, edge = merged, low_, high_, edge[at]
        yield names, low, high


def stand_ins(hashes: np.ndarray, edge: np.ndarray, starts: np.ndarray, width: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window, number of windows): runs of the windows that begin at ``starts`` (ascending) and are stood for by one
    symbol, with a hash of it and of the words that decide it.  Key 0: by a single word, which says nothing."""
    level_of, low_of, high_of = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    todo = np.arange(len(starts))
    for level, (_, low, high) in reversed(list(enumerate(levels(hashes, edge, rounds)))):
        if not level or not len(todo):
            break
        p = starts[todo]
        at = np.searchsorted(low, p)
        fits = at < len(low)
        fits[fits] = high[at[fits]] <= p[fits] + width
        hit, at = todo[fits], at[fits]
        level_of[hit], low_of[hit], high_of[hit] = level, low[at], high[at]
        todo = todo[~fits]
    new = np.ones(len(starts), bool)
    new[1:] = (level_of[1:] != level_of[:-1]) | (low_of[1:] != low_of[:-1]) | (high_of[1:] != high_of[:-1]) | (np.diff(starts) != 1)
    at = np.flatnonzero(new)
    times = -(-np.diff(np.append(at, len(starts))) // 255)  # counts are single bytes
    at = np.repeat(at, times) + 255 * (np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times))
    level, a, b = level_of[at], low_of[at], high_of[at]
    power, inverse = textblocks.power_tables(len(hashes) + 1)
    with np.errstate(over="ignore"):
        sums = np.append(np.uint64(0), np.cumsum(hashes * power[: len(hashes)]))
        key = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * _A + level.astype(np.uint64) * _B)
    return np.where(level > 0, key | np.uint64(1), np.uint64(0)), starts[at], np.diff(np.append(at, len(starts)))


class Slice:
    """The words of a slice: hashes, the document each belongs to, and the ids of the documents."""

    def __init__(self, text: bytes, rows: bytes) -> None:
        n = (len(rows) - 8) // 17
        self.ids, lengths, self.null = np.frombuffer(rows, np.int64, n), np.frombuffer(rows, np.int64, n, 8 * n), np.frombuffer(rows, np.uint8, n, 16 * n) > 0
        self.raw = np.frombuffer(pa.decompress(text, int.from_bytes(rows[-8:], "little"), codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
        self.starts, self.ends, self.first = textblocks.words(self.raw, np.append(0, np.cumsum(lengths)))
        self._hashes: np.ndarray | None = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = exact_hashes(self.raw, self.starts, self.ends)
        return self._hashes

    def windows(self, width: int, docs: np.ndarray | None = None) -> np.ndarray:
        """Where windows begin, of all documents or the marked ones."""
        n = len(self.starts)
        ok = np.zeros(n + 1, np.int64)
        some = np.diff(self.first) >= width
        if docs is not None:
            some &= docs
        np.add.at(ok, self.first[:-1][some], 1)
        np.add.at(ok, self.first[1:][some] - width + 1, -1)
        return np.flatnonzero(np.cumsum(ok[:n]) > 0)

    def doc_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, words, "right") - 1

    def order_ids(self) -> np.ndarray:
        """Ids to compare by; a null one comes behind all others."""
        return np.where(self.null, np.iinfo(np.int64).max, self.ids)

    def edges(self) -> np.ndarray:
        out = np.zeros(len(self.starts) + 1, bool)
        out[self.first[:-1]] = True
        return out[:-1]

    def signatures(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, two 64-bit hashes of all its words), of those that have a window."""
        docs = np.flatnonzero(np.diff(self.first) >= width)
        out = []
        for salt in (_A, _B):
            with np.errstate(over="ignore"):
                h = mix(self.hashes * salt + np.uint64(1))
                place = (np.arange(len(h)) - np.repeat(self.first[:-1], np.diff(self.first))).astype(np.uint64)
                sums = np.append(np.uint64(0), np.cumsum(mix(h + place * _C)))
                out.append(mix(sums[self.first[1:][docs]] - sums[self.first[:-1][docs]] + np.diff(self.first)[docs].astype(np.uint64)))
        return docs, out[0], out[1]


def _by_block(keys: np.ndarray, bits: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(order, [(block, from, to)]): entries by the upper bits of their keys, otherwise in their order."""
    if not len(keys):
        return np.zeros(0, np.int64), []
    block = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    order = np.argsort(block, kind="stable")
    block = block[order]
    edges = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    return order, list(zip(block[edges].tolist(), edges.tolist(), np.append(edges[1:], len(block)).tolist(), strict=True))


def _steps(x: np.ndarray) -> bytes:
    """Ascending numbers as the steps between them, byte by byte, so that high ones, mostly 0, compress."""
    return np.diff(x, prepend=0).astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unsteps(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel(), dtype=np.int64)


def _packed(slice_bytes: int):
    """The slices: number, compressed text, and of the rows the ids, lengths and which ids are null."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, stop, raw, offsets in slices(batch.column("text"), slice_bytes):
                rows = batch.slice(at, stop - at)
                ids, null = rows.column("doc_id").fill_null(0).to_numpy(), rows.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                more = ids.astype(np.int64).tobytes() + np.diff(offsets).astype(np.int64).tobytes() + null.astype(np.uint8).tobytes() + len(raw).to_bytes(8, "little")
                text = pa.compress(raw.tobytes(), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([text], pa.binary()), pa.array([more], pa.binary())], ["slice", "text", "rows"])
                number += 1

    return run


def _of(batch: pa.RecordBatch) -> Iterator[tuple[int, Slice]]:
    for number, text, rows in zip(*(batch.column(c) for c in ("slice", "text", "rows")), strict=True):
        yield number.as_py(), Slice(text.as_py(), rows.as_py())


def _pieces(starts: np.ndarray, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, windows) of pieces of the words that hold those windows whole."""
    at = 0
    while at < len(starts):
        base = int(starts[at])
        stop = int(np.searchsorted(starts, base + PIECE))
        yield base, int(starts[stop - 1]) + width, starts[at:stop] - base
        at = stop


def _symbols(bits: int, width: int):
    """By block the symbols that stand for windows, and the signatures of whole documents."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, own in _of(batch):
                out, edges = [], own.edges()
                docs, one, two = own.signatures(width)
                order, parts = _by_block(one, bits)
                ids = own.order_ids()
                for block, a, b in parts:
                    o = order[a:b]
                    out.append((number, TEXT, block, np.concatenate([one[o], two[o], ids[docs[o]].view(np.uint64), docs[o].astype(np.uint64)]).tobytes()))
                keys, begins, counts = [], [], []
                for base, end, starts in _pieces(own.windows(width), width):
                    edge = edges[base:end].copy()
                    edge[:1] = True
                    key, first, n = stand_ins(own.hashes[base:end], edge, starts, width)
                    keys.append(key)
                    begins.append(first + base)
                    counts.append(n)
                if keys:
                    key, first, n = np.concatenate(keys), np.concatenate(begins), np.concatenate(counts)
                    bare = key == 0  # nothing to ask: they are compared as wholes
                    if bare.any():
                        out.append((number, RANGE, _home(number, bits), _ranges(first[bare], n[bare])))
                    key, first, n = key[~bare], first[~bare], n[~bare]
                    order, parts = _by_block(key, bits)
                    out += [(number, SYMBOL, block, key[o].tobytes() + _ranges(first[o], n[o])) for block, o in ((block, order[a:b]) for block, a, b in parts)]
                yield _mail(out)

    return run


def _home(number: int, bits: int) -> int:
    return int(mix(np.array([number], np.uint64))[0] >> np.uint64(64 - bits)) if bits else 0


def _ranges(first: np.ndarray, n: np.ndarray) -> bytes:
    return _steps(first) + n.astype(np.uint8).tobytes()


def _unranges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 5
    return _unsteps(data[: 4 * n]), np.frombuffer(data, np.uint8, n, 4 * n).astype(np.int64)


def _shared(_: tuple, table: pa.Table) -> pa.Table:
    """Of a block's symbols the windows of those that occur more than once; of its documents those that are copies of an earlier one."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("slice", "kind", "data")), strict=True))
    out = [(s, RANGE, 0, d) for s, kind, d in rows if kind == RANGE]
    asked = [(s, d) for s, kind, d in rows if kind == SYMBOL]
    if asked:
        sizes = [len(d) // 13 for _, d in asked]
        keys = [np.frombuffer(d, np.uint64, n) for (_, d), n in zip(asked, sizes, strict=True)]
        order = np.sort(np.concatenate(keys))
        many = np.unique(order[1:][order[1:] == order[:-1]])
        for (s, d), n, key in zip(asked, sizes, keys, strict=True):
            at = np.minimum(np.searchsorted(many, key), max(len(many) - 1, 0))
            hit = many[at] == key if len(many) else np.zeros(n, bool)
            if hit.any():
                first, count = _unranges(d[8 * n :])
                out.append((s, RANGE, 0, _ranges(first[hit], count[hit])))
    texts = [(s, np.frombuffer(d, np.uint64).reshape(4, -1)) for s, kind, d in rows if kind == TEXT]
    if texts:
        all_ = np.concatenate([x for _, x in texts], axis=1)
        where = np.concatenate([np.full(x.shape[1], i) for i, (_, x) in enumerate(texts)])
        ids = all_[2].view(np.int64)
        order = np.lexsort((ids, all_[1], all_[0]))
        new = np.concatenate(([True], (all_[:2, order][:, 1:] != all_[:2, order][:, :-1]).any(axis=0)))
        least = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        copy = np.zeros(len(order), bool)
        copy[order] = ids[order] > least
        for i in np.unique(where[copy]).tolist():
            out.append((texts[i][0], COPY, 0, all_[3][copy & (where == i)].astype(np.int64).tobytes()))
    return pa.Table.from_batches([_mail(out)])


def _candidates(own: Slice, answers: list[tuple[int, bytes]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows that may occur elsewhere, marks of documents that are copies)."""
    copy = np.zeros(len(own.ids), bool)
    ok = np.zeros(len(own.starts) + 2, np.int64)
    for kind, data in answers:
        if kind == COPY:
            copy[np.frombuffer(data, np.int64)] = True
        elif kind == RANGE:
            first, n = _unranges(data)
            np.add.at(ok, first, 1)
            np.add.at(ok, first + n, -1)
    at = np.flatnonzero(np.cumsum(ok)[: len(own.starts)] > 0)
    return at[~copy[own.doc_of(at)]], copy


def _digests(hashes: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the windows at ``at``."""
    out = []
    for salt in (_A, _B):
        with np.errstate(over="ignore"):
            total, factor = np.zeros(len(at), np.uint64), salt
            for j in range(width):
                total += mix(hashes[at + j] ^ salt) * factor if salt is _B else hashes[at + j] * factor
                factor = factor * _C | np.uint64(1)
            out.append(mix(total))
    return out[0], (out[1] >> np.uint64(32)).astype(np.uint32)


def _wholes(bits: int, width: int):
    """By block the windows that may occur elsewhere; those that occur earlier in their own slice are settled here."""

    def run(_: tuple, answers: pa.Table, texts: pa.Table) -> pa.Table:
        out = []
        for number, own in _of(texts.combine_chunks().to_batches()[0]) if texts.num_rows else ():
            at, copy = _candidates(own, list(zip(answers.column("kind").to_pylist(), answers.column("data").to_pylist(), strict=True)), width)
            home, later = _home(number, bits), []
            out.append((number, COPY, home, np.flatnonzero(copy).astype(np.int64).tobytes()))
            if len(at):
                one, two = (np.concatenate(x) for x in zip(*(_digests(own.hashes, at[i : i + PIECE], width) for i in range(0, len(at), PIECE)), strict=True))
                ids, place = own.order_ids()[own.doc_of(at)], at - own.first[own.doc_of(at)]
                order = np.lexsort((place, ids, two, one))
                new = np.concatenate(([True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])))
                lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
                behind = (ids[order] > ids[lead]) | (place[order] > place[lead])
                later = np.sort(at[order[behind]])
                kept = np.sort(order[~behind])
                o, parts = _by_block(one[kept], bits)
                for block, a, b in parts:
                    k = kept[o[a:b]]
                    out.append((number, SYMBOL, block, one[k].tobytes() + two[k].tobytes() + ids[k].tobytes() + _steps(at[k]) + _steps_any(place[k])))
                out.append((number, LATER, home, _steps(later)))
        return pa.Table.from_batches([_mail(out)])

    return run


def _steps_any(x: np.ndarray) -> bytes:
    return x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unsteps_any(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel().astype(np.int64)


def _earliest(_: tuple, table: pa.Table) -> pa.Table:
    """Of a block's windows those that begin earlier elsewhere, by slice; what slices have settled passes through."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("slice", "kind", "data")), strict=True))
    out = [(s, kind, 0, d) for s, kind, d in rows if kind != SYMBOL]
    asked = [(s, d, len(d) // 28) for s, kind, d in rows if kind == SYMBOL]
    if asked:
        cut = lambda kind, size, at: np.concatenate([np.frombuffer(d, kind, n, at * n) for _, d, n in asked])
        one, two, ids = cut(np.uint64, 8, 0), cut(np.uint32, 4, 8), cut(np.int64, 8, 12)
        place = np.concatenate([_unsteps_any(d[24 * n :]) for _, d, n in asked])
        order = np.lexsort((place, ids, two, one))
        new = np.concatenate(([True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])))
        lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        later = np.zeros(len(order), bool)
        later[order] = (ids[order] > ids[lead]) | (place[order] > place[lead])
        at = 0
        for s, d, n in asked:
            own = later[at : at + n]
            at += n
            if own.any():
                out.append((s, LATER, 0, _steps(_unsteps(d[20 * n : 24 * n])[own])))
    return pa.Table.from_batches([_mail(out)])


_CUT = "doc_id long, n_words long, n_removed long, text binary"


def _removed(width: int, whole: bool):
    """Each document without the words of windows that begin earlier elsewhere: its kept words, or their digest."""

    def run(_: tuple, answers: pa.Table, texts: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        for _number, own in _of(texts.combine_chunks().to_batches()[0]) if texts.num_rows else ():
            cover = np.zeros(len(own.starts) + width + 1, np.int64)
            for kind, data in zip(answers.column("kind").to_pylist(), answers.column("data").to_pylist(), strict=True):
                if kind == LATER:
                    at = _unsteps(data)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + width, -1)
                elif kind == COPY:
                    docs = np.frombuffer(data, np.int64)
                    np.add.at(cover, own.first[docs], 1)
                    np.add.at(cover, own.first[docs + 1], -1)
            gone = np.cumsum(cover)[: len(own.starts)] > 0
            n_gone = np.append(0, np.cumsum(gone))
            data = own.raw.tobytes()
            for i, (a, b) in enumerate(zip(own.first[:-1].tolist(), own.first[1:].tolist(), strict=True)):
                keep = np.flatnonzero(~gone[a:b]) + a
                text = b" ".join([data[s:e] for s, e in zip(own.starts[keep].tolist(), own.ends[keep].tolist(), strict=True)])
                for column, v in zip(out, (None if own.null[i] else int(own.ids[i]), b - a, int(n_gone[b] - n_gone[a]), text if whole else hashlib.sha256(text).hexdigest().encode()), strict=True):
                    column.append(v)
        return pa.table([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], [f.split()[0] for f in _CUT.split(", ")])

    return run


def without_repeats(docs: DataFrame, width: int = WINDOW, texts: bool = True, block_bits: int | None = None, slice_bytes: int = SLICE) -> DataFrame:
    """doc_id, n_words, n_removed, and the kept words joined by one space (``text``) or, without ``texts``, their ``kept_sha256``.

    A row for each row of ``docs`` (doc_id, text, more).  Words are runs of bytes other than ASCII white space, unchanged.  A
    word goes if a window of ``width`` consecutive words of its document covers it whose words also begin earlier: in a
    document with a smaller doc_id, or at a smaller word of the same one.  Windows are judged on the input.  Null and
    blank texts have no words.  A null doc_id counts as larger than all others.  Rows that share a doc_id are one document, each
    beginning at its first word: windows at equal places of them are not earlier than one another.  An empty table gives none;
    other columns are ignored.  ``block_bits`` (blocks of hashes, as a power of two; by the input if not given) and
    ``slice_bytes`` steer memory and not the result.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = block_bits if block_bits is not None else (input_bytes(source) // BLOCK_BYTES).bit_length()
    cut = stored(source.mapInArrow(_packed(slice_bytes), "slice long, text binary, rows binary"), "slices")
    asked = cut.mapInArrow(_symbols(bits, width), _MAIL)
    shared = asked.groupBy("block").applyInArrow(_shared, _MAIL)
    wholes = shared.groupBy("slice").cogroup(cut.groupBy("slice")).applyInArrow(_wholes(bits, width), _MAIL)
    later = wholes.groupBy("block").applyInArrow(_earliest, _MAIL)
    again = docs.sparkSession.read.schema(cut.schema).parquet(cut._acreflow_path)
    out = later.groupBy("slice").cogroup(again.groupBy("slice")).applyInArrow(_removed(width, texts), _CUT)
    last = F.col("text").cast("string").alias("text" if texts else "kept_sha256")
    return out.select("doc_id", "n_words", "n_removed", last)


#: The same by DuckDB.
ORACLE_SQL = rf"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
words AS (SELECT r, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM numbered),
windows AS (SELECT r, doc_id, s AS i, array_to_string(w[s : s + {WINDOW - 1}], ' ') AS run FROM numbered, unnest(range(1, len(w) - {WINDOW - 2})) AS t(s)),
earliest AS (SELECT run, min(struct_pack(d := doc_id, i := i)) AS least FROM windows GROUP BY run),
later AS (SELECT r, i FROM windows JOIN earliest USING (run) WHERE struct_pack(d := doc_id, i := i) > least),
last AS (SELECT w.r, w.i, w.word, max(l.i) OVER (PARTITION BY w.r ORDER BY w.i) AS upto FROM words w LEFT JOIN later l ON l.r = w.r AND l.i = w.i),
kept AS (SELECT r, count(*) FILTER (WHERE upto > i - {WINDOW}) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE coalesce(upto <= i - {WINDOW}, true)) AS text FROM last GROUP BY r)
SELECT n.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM numbered n LEFT JOIN kept k ON k.r = n.r
"""
