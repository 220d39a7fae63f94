"""Token counts by a linear longest-match automaton.

Greedy longest-match pieces of a word are counted without building them: a trie of the vocabulary has, for
each node, a failure link to where matching goes on after the pieces that are then known, and how many these
are.  Every symbol and every failure step is taken once, so a word takes time linear in its length.  Distinct
words of a slice run through the automaton side by side.  Pieces that may only continue a word (written ##x)
have a root of their own.  A vocabulary that marks the ends of words has its marks matched as a symbol after the last
byte, so a marked piece can only end a word; an end that no marked piece takes is a token of its own.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreflow.llm.textblocks import LOWER, slices, tidy, word_hashes, words

#: The symbol after the last byte of a word.
END = 256
_SYMBOLS = 257
#: Words longer than this go through the automaton one at a time.
SIDE_BY_SIDE = 256


@dataclass(frozen=True)
class Automaton:
    keys: np.ndarray  # node * _SYMBOLS + symbol, ascending
    to: np.ndarray
    fail: np.ndarray  # -1: no piece fits
    popped: np.ndarray
    inner: int  # the root after the first piece; a word begins at node 0
    ends: bool  # whether words are followed by END


def build(first: Iterable[Sequence[int]], later: Iterable[Sequence[int]] | None = None) -> Automaton:
    """The automaton of the pieces that can begin a word and of those that can continue it (the same ones by default).

    A piece is a sequence of bytes, END after them if it is marked as one that ends a word.
    """
    first = list(first)
    ends = any(len(p) and p[-1] == END for p in first)
    first += [(END,)] * ends
    edges: list[dict[int, int]] = [{}]
    is_piece = [False]
    inner = 0

    def add(pieces: Iterable[Sequence[int]], root: int) -> None:
        for piece in pieces:
            node = root
            for symbol in piece:
                node = edges[node].setdefault(symbol, len(edges))
                if node == len(edges):
                    edges.append({})
                    is_piece.append(False)
            is_piece[node] = is_piece[node] or node != root

    add(first, 0)
    if later is not None:
        inner = len(edges)
        edges.append({})
        is_piece.append(False)
        add(later, inner)
    fail, popped = [-1] * len(edges), [0] * len(edges)
    level = [0, inner] if inner else [0]
    while level:
        below = []
        for u in level:
            for symbol, v in edges[u].items():
                below.append(v)
                if is_piece[v]:
                    fail[v], popped[v] = inner, 1
                    continue
                z, n = (fail[u], popped[u]) if u not in (0, inner) else (-1, 0)
                while z >= 0 and symbol not in edges[z]:
                    n += popped[z]
                    z = fail[z]
                if z >= 0:
                    fail[v], popped[v] = edges[z][symbol], n
        level = below
    keys = np.array([u * _SYMBOLS + s for u, e in enumerate(edges) for s in e], np.int64)
    to = np.array([v for e in edges for v in e.values()], np.int32)
    order = np.argsort(keys)
    return Automaton(keys[order], to[order], np.array(fail, np.int32), np.array(popped, np.int32), inner, ends)


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write bytes as characters: printable ones as themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def load_pieces(path: str) -> tuple[list[Sequence[int]], list[Sequence[int]] | None]:
    """The pieces of a vocabulary file: of a ``tokenizers`` file with a byte-level vocabulary, its end-of-word
    suffix read as END, or of a text file with a piece in each line and ## before continuing ones."""
    if not path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            lines = [x.rstrip("\n") for x in f]
        return [x.encode() for x in lines if x and not x.startswith("##")], [x[2:].encode() for x in lines if x.startswith("##") and x[2:]]
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte, suffix = _byte_of_char(), model.get("end_of_word_suffix") or ""
    out = []
    for piece in model["vocab"]:
        marked = bool(suffix) and piece.endswith(suffix)
        body = piece.removesuffix(suffix)
        if body and all(c in byte for c in body):
            out.append((*(byte[c] for c in body), *[END] * marked))
    return sorted(out), None


def count_one(a: Automaton, word: bytes) -> int:
    """The number of pieces of one word; -1 if no pieces make it up."""
    state, n = 0, 0
    for symbol in (*word, *[END] * a.ends):
        while True:
            key = state * _SYMBOLS + symbol
            at = int(np.searchsorted(a.keys, key))
            if at < len(a.keys) and a.keys[at] == key:
                state = int(a.to[at])
                break
            if a.fail[state] < 0:
                return -1
            n += int(a.popped[state])
            state = int(a.fail[state])
    while state != a.inner:
        if a.fail[state] < 0:
            return -1
        n += int(a.popped[state])
        state = int(a.fail[state])
    return n


def count_many(a: Automaton, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of pieces of each (non-empty) word; -1 if no pieces make it up."""
    length = ends - starts + a.ends
    n, state = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    if not len(a.keys):
        return n - 1

    def fall(todo: np.ndarray) -> np.ndarray:
        """Follows the failure links of ``todo``; those that have none are given up."""
        stuck = a.fail[state[todo]] < 0
        n[todo[stuck]] = -1
        todo = todo[~stuck]
        n[todo] += a.popped[state[todo]]
        state[todo] = a.fail[state[todo]]
        return ~stuck

    alive = np.flatnonzero(length <= SIDE_BY_SIDE)
    side_by_side = alive
    j = 0
    while len(alive := alive[(length[alive] > j) & (n[alive] >= 0)]):
        todo, last = alive, a.ends & (length[alive] == j + 1)
        symbol = np.where(last, END, raw[np.where(last, 0, starts[alive] + j)].astype(np.int64))
        while len(todo):
            key = state[todo] * _SYMBOLS + symbol
            at = np.minimum(np.searchsorted(a.keys, key), len(a.keys) - 1)
            hit = a.keys[at] == key
            state[todo[hit]] = a.to[at[hit]]
            todo, symbol = todo[~hit], symbol[~hit]
            on = fall(todo)
            todo, symbol = todo[on], symbol[on]
        j += 1
    rest = side_by_side[n[side_by_side] >= 0]
    while len(rest := rest[state[rest] != a.inner]):
        rest = rest[fall(rest)]
    for i in np.flatnonzero(length > SIDE_BY_SIDE).tolist():
        n[i] = count_one(a, raw[starts[i] : ends[i]].tobytes())
    return n


def _counted(shared):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        for batch in batches:
            parts = []
            for first_row, stop, raw, offsets in slices(batch.column("text"), 8 << 20):
                starts, ends, first = words(raw, offsets)
                _, index, inverse = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
                own = count_many(a, LOWER[raw], starts[index], ends[index])[inverse]
                doc, n = np.repeat(np.arange(stop - first_row), np.diff(first)), stop - first_row
                unknown = own < 0
                parts.append((np.bincount(doc, np.where(unknown, 1, own), minlength=n), np.diff(first), np.bincount(doc, unknown, minlength=n)))
            columns = [np.concatenate([np.zeros(0), *(p[i] for p in parts)]).astype(np.int64) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], ["doc_id", "n_tokens", "n_words", "n_unknown"])

    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, n_words, n_unknown), a row for each row of ``docs`` (doc_id, text, more).

    Words are separated by ASCII white space, A-Z are lower-cased; each is cut into the longest pieces from
    the left; a word that no pieces make up is one token, and counted as unknown.  Null, empty and blank text: zeros.
    Very long texts and words are read whole.
    Repeated rows and null ids are rows like any other; other columns are ignored.  The vocabulary is read by
    the driver and its automaton, of a size bounded by it, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(build(*load_pieces(path)))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(_counted(shared), "doc_id long, n_tokens long, n_words long, n_unknown long")
