"""Token ids of whole Arrow text columns, by the ``tokenizers`` library, each distinct word encoded once.

Some tokenizers drop white space before they do anything else, so the ids of a text are those of its
white-space separated words in a row.  For these, words are hashed in bulk and looked up among the words that
this worker has met; only new ones go to the library.  Other tokenizers encode whole texts.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from acreflow.llm.textblocks import slices, string_buffer, word_hashes, words

#: Distinct words that a worker keeps; beyond that it keeps those met again since the last time.
KEPT_WORDS = 1_500_000


class TextEncoder:
    """Encodes with the tokenizer file at ``path``, without special tokens around a text."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._encode = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = _drops_space(spec)
        self._hash = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int64)
        self._hits = np.zeros(0, np.uint8)
        self._starts = np.zeros(1, np.int64)
        self._pool = np.zeros(0, np.uint32)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._encode.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids (uint32) of each text of the column; none for null."""
        if not self.by_word:
            for text in column:
                yield np.array(self._plain([text.as_py() or ""])[0], np.uint32)
            return
        for _, _, raw, offsets in slices(column, 8 << 20):
            starts, ends, first = words(raw, offsets)
            met, inverse = self._look_up(raw, starts, ends)
            begin, count = self._starts[met], self._starts[met + 1] - self._starts[met]
            begin, count = begin[inverse], count[inverse]
            total = np.concatenate(([0], np.cumsum(count)))
            flat = self._pool[np.repeat(begin - total[:-1], count) + np.arange(total[-1])]
            edges = total[first].tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield flat[a:b]

    def _look_up(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pool entries of the distinct words, and which of them each word is."""
        own, index, inverse = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self._hash, own)
        known = at < len(self._hash)
        known[known] = self._hash[at[known]] == own[known]
        new = np.flatnonzero(~known)
        if len(new):
            if len(self._hash) + len(new) > KEPT_WORDS:
                self._forget()
                return self._look_up(raw, starts, ends) if len(self._hash) or len(new) <= KEPT_WORDS else self._once(raw, starts, ends, own, index, inverse)
            self._learn(raw, starts, ends, own[new], index[new])
            at = np.searchsorted(self._hash, own)
        self._hits[at] = np.minimum(self._hits[at], 254) + 1
        return self._at[at], inverse

    def _learn(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, own: np.ndarray, index: np.ndarray) -> None:
        data = raw.tobytes()
        new = self._plain([data[a:b].decode("utf-8", "replace") for a, b in zip(starts[index].tolist(), ends[index].tolist(), strict=True)])
        n = len(self._starts) - 1
        count = np.fromiter(map(len, new), np.int64, len(new))
        self._pool = np.concatenate((self._pool, np.fromiter((i for x in new for i in x), np.uint32, int(count.sum()))))
        self._starts = np.concatenate((self._starts, self._starts[-1] + np.cumsum(count)))
        merged = np.concatenate((self._hash, own))
        order = np.argsort(merged, kind="stable")
        self._hash = merged[order]
        self._at = np.concatenate((self._at, np.arange(n, n + len(own))))[order]
        self._hits = np.concatenate((self._hits, np.zeros(len(own), np.uint8)))[order]

    def _forget(self) -> None:
        """Keeps the words met at least twice, if that makes room; else none."""
        keep = np.flatnonzero(self._hits > 1)
        if 2 * len(keep) > KEPT_WORDS:
            keep = keep[:0]
        old, count = self._at[keep], self._starts[self._at[keep] + 1] - self._starts[self._at[keep]]
        total = np.concatenate(([0], np.cumsum(count)))
        self._pool = self._pool[np.repeat(self._starts[old] - total[:-1], count) + np.arange(total[-1])]
        self._hash, self._at, self._starts, self._hits = self._hash[keep], np.arange(len(keep)), total, np.zeros(len(keep), np.uint8)

    def _once(self, raw, starts, ends, own, index, inverse) -> tuple[np.ndarray, np.ndarray]:
        """One slice with more new words than are kept: learned for itself."""
        self._learn(raw, starts, ends, own, index)
        return self._at[np.searchsorted(self._hash, own)], inverse


def _drops_space(spec: dict) -> bool:
    """Whether the file describes a tokenizer that turns white space to single spaces and then keeps none."""
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    lower = any(s.get("type") == "Lowercase" for s in steps)
    split = splits[0] if splits else {}
    return lower and split.get("type") == "Split" and split.get("behavior") == "Removed" and bool(split.get("invert")) and "[^\\s" in split.get("pattern", {}).get("Regex", "")


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """This worker's encoder for a file."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


__all__ = ["TextEncoder", "encoder", "string_buffer"]
