"""Packing documents into training sequences: bounded-space online best fit.

A partition keeps a fixed number of open windows.  A document goes, uncut, into the window that it leaves
least room in; where none has room, the fullest one is emitted.  A document longer than a window is cut into
full sequences first.  What is still open at the end of a partition is poured together with the leftovers of
a bounded number of other partitions into full sequences, and each pour's tail is cut at powers of two, so
leftovers carry no padding.  Memory is a few windows of ids per task, whatever the input.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreflow.llm.subwords import encoder
from acreflow.llm.textblocks import tidy
from acreflow.plans.storage import stored

WINDOW = 4096
OPEN = 64
#: Partitions whose leftovers are poured together: at most GROUP * OPEN windows of ids in one task.
GROUP = 32

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class OpenWindows:
    """At most ``limit`` windows with room; each is [used, pieces]."""

    def __init__(self, size: int, limit: int) -> None:
        self.size, self.limit = size, limit
        self.rooms: list[tuple[int, int]] = []  # (room, key), ascending
        self.windows: dict[int, list] = {}
        self.made = 0

    def place(self, piece: tuple, length: int) -> list | None:
        """Puts a piece of at most ``size`` tokens somewhere; a window's pieces if one is to be emitted."""
        out = None
        at = bisect_left(self.rooms, (length, -1))
        if at < len(self.rooms):
            room, key = self.rooms.pop(at)
        else:
            if len(self.rooms) == self.limit:
                out = self.windows.pop(self.rooms.pop(0)[1])
            room, key = self.size, self.made
            self.made += 1
            self.windows[key] = []
        self.windows[key].append((*piece, self.size - room))
        if room > length:
            insort(self.rooms, (room - length, key))
            return out
        full = self.windows.pop(key)
        if out is None:
            return full
        return out + [None] + full

    def rest(self) -> list[list]:
        return [self.windows[k] for k in sorted(self.windows)]


def _packer(path: str, end_id: int, size: int, limit: int, with_ids: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tokens, windows, number = encoder(path), OpenWindows(size, limit), 0
        rows: list[tuple] = []

        def emit(pieces: list) -> None:
            nonlocal number
            for p in [*pieces, None]:
                if p is None:
                    number += 1
                else:
                    doc, start, ids, total, offset = p
                    rows.append((doc, start, len(ids), crc(ids), total, (part << 32) + number, offset, ids.tobytes() if with_ids else None, None))

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.binary(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [*_FIELDS, "ids", "left"])
            rows.clear()
            return out

        for b in batches:
            docs = b.column("doc_id").to_pylist()
            for doc, ids in zip(docs, tokens.ids(b.column("text")), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype(np.uint32)
                n, at = len(ids), 0
                while n - at >= size:
                    emit([(doc, at, ids[at : at + size], n, 0)])
                    at += size
                if at < n:
                    done = windows.place((doc, at, ids[at:], n), n - at)
                    if done is not None:
                        emit(done)
                if len(rows) >= 8192:
                    yield batch()
        if rows:
            yield batch()
        for w, pieces in enumerate(windows.rest()):
            for doc, start, ids, total, offset in pieces:
                rows.append((doc, start, len(ids), 0, total, (part << 32) + w, offset, ids.tobytes(), part))
        if rows:
            yield batch()

    return run


def _pourer(size: int, with_ids: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        number = (1 << 62) + (key[0].as_py() << 32)
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        left = sum(table.column("length").to_pylist())
        room, offset, rows = min(size, left), 0, []
        if room < size:
            room = 1 << (room.bit_length() - 1)
        for doc, start, total, raw in zip(*(table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True):
            ids, at = np.frombuffer(raw, np.uint32), 0
            while at < len(ids):
                take = min(room - offset, len(ids) - at)
                part = ids[at : at + take]
                rows.append((doc, start + at, take, crc(part), total, number, offset, part.tobytes() if with_ids else None))
                at, offset, left = at + take, offset + take, left - take
                if offset == room:
                    number, offset = number + 1, 0
                    room = size if left >= size else 1 << max(0, left.bit_length() - 1)
        kinds = [pa.int64()] * 7 + [pa.binary()]
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [*_FIELDS, "ids"])

    return run


def pack(docs: DataFrame, path: str, end_id: int = 2, size: int = WINDOW, limit: int = OPEN, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each row of ``docs`` (doc_id, text, more): doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, and with ``with_ids`` the ids as little-endian unsigned 32-bit binary.

    A document's ids are those of ``path``'s tokenizer, without special tokens, then ``end_id``; each lies in
    exactly one piece.  Null and empty text: the end id alone.  Repeated rows and null ids are packed like
    any other row.  An empty table gives no row.  Other columns are ignored.  ``size`` is a power of two.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    placed = stored(source.mapInArrow(_packer(path, end_id, size, limit, with_ids), f"{_PIECE}, ids binary, left long"), "placed")
    shown = [*_FIELDS, *["ids"] * with_ids]
    poured = placed.filter("left is not null").groupBy(F.expr(f"left div {GROUP}").alias("g")).applyInArrow(_pourer(size, with_ids), f"{_PIECE}, ids binary")
    return placed.filter("left is null").select(shown).unionByName(poured.select(shown))
