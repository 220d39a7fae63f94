"""Array kernels over whole Arrow string columns: words, their 64-bit hashes and word-shingle sets.

Words are maximal runs of bytes other than ASCII white space (0x20, 0x09-0x0D), with A-Z lower-cased.
Everything works on the column's own byte buffer, with a window of bounded size for the 8-byte
intermediates, so a very long text costs little more than its own bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COEF = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
WINDOW = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def give_back() -> None:
    """Returns memory that is free to the system: workers live on between stages, and the C library keeps what large arrays leave."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a partition that gives memory back before it begins and when it ends."""

    @wraps(run)
    def out(batches: Iterator) -> Iterator:
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(a: np.ndarray) -> np.ndarray:
    """The distinct entries, ascending; by sorting, which for these hashes is several times as fast as numpy's own hashing."""
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) else a


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of an odd base modulo 2**64, and of its inverse."""
    size = max(n, WINDOW)
    if size not in _powers:
        if size > WINDOW:  # one word longer than a window: not worth keeping
            return _geometric(_BASE, size), _geometric(pow(_BASE, -1, 2**64), size)
        _powers[size] = _geometric(_BASE, size), _geometric(pow(_BASE, -1, 2**64), size)
    return _powers[size]


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets into them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows with at most ``limit`` bytes, or one row."""
    raw, offsets = string_buffer(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, stop, raw[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop


def words(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each document and the total) of all words, in order."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    gap = separator[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = edge[:n].copy()
    before[1:] |= gap[:-1]
    after = edge[1:].copy()
    after[:-1] |= gap[1:]
    starts = np.flatnonzero(before & ~gap)
    ends = np.flatnonzero(after & ~gap) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A mixed 64-bit polynomial hash of each word, lower-cased (A-Z) or as it is, by prefix sums modulo 2**64."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            base = int(starts[at])
            stop = max(at + 1, int(np.searchsorted(ends, base + WINDOW, "right")))
            last = int(ends[stop - 1])
            power, inverse = power_tables(last - base)
            sums = np.zeros(last - base + 1, np.uint64)
            np.cumsum(_BYTE[LOWER[raw[base:last]] if fold else raw[base:last]] * power[: last - base], out=sums[1:])
            s, e = starts[at:stop] - base, ends[at:stop] - base
            out[at:stop] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
            at = stop
    return out


def combine(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` consecutive words (empty if there are fewer)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, np.uint64(width) * _COEF[63])
        for j in range(width):
            total += hashes[j : j + n] * _COEF[j]
        return mix(total)


def shingle_sets(hashes: np.ndarray, first: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each document the sorted distinct hashes of its ``width``-word shingles.

    A document with fewer words has one shingle, its whole sequence; one without words has none.
    """
    runs = combine(hashes, width)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            s = np.sort(runs[a : b - width + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            yield combine(hashes[a:b], b - a)
        else:
            yield runs[:0]
