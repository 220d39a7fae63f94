"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other; the model of a category has the probabilities of the earlier
ones among its inputs.  In training these are out-of-fold predictions, so a later model sees them as wrong as
they will be on new text.

Inputs are hashed words and word beginnings of the whole text: whether one is there, how often, and how dense.
Models are fitted by the driver on a bounded sample of labelled rows and a bounded number of inputs of each model,
both parameters of the calls, chosen by a two-sample test over that sample; everything else covers all rows.  The
models that predict a fold are fitted on the other folds alone, their inputs chosen by the labels of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreflow.llm.textblocks import slices, tidy, word_hashes, words
from acreflow.plans.storage import stored

#: Labelled rows that the classifiers are fitted on, at most: those with the smallest hashes of their ids.
SAMPLE = 6_000
#: (input, level) pairs that a model has weights for, at most: those that tell the classes apart best.
INPUTS = 1_024
FOLDS = 3
#: Word beginnings of so many bytes are inputs besides whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
COUNTS = (1, 2, 3, 5)
DENSITIES = (2.0, 5.0, 10.0, 20.0, 40.0)  # per 1000 words, of 20 at least
#: Bytes of text that a task works on at once: each word has six inputs, of some 100 bytes each for a while.
SLICE = 2 << 20
LEVELS = len(COUNTS) + len(DENSITIES)
#: Rows of the sample that an input must be in to be tested.
LEAST_ROWS = 5
#: The chain: categories in order, with the SQL that labels a row of ``labels``.
CHAIN = (("junk", "quality = 0"), ("toxic", "toxic = 1"))

_GAP = np.ones(256, bool)
_GAP[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = False
_GAP[128:] = False


@dataclass
class Link:
    """One model of the chain: weights by (input, level), for the earlier probabilities, and a constant."""

    name: str
    inputs: np.ndarray  # hashes, ascending
    weights: np.ndarray  # (len(inputs), LEVELS)
    earlier: np.ndarray
    constant: float


@dataclass
class Chain:
    links: list[Link] = field(default_factory=list)

    def predict(self, found: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Probabilities, a row for each document and a column for each category."""
        doc, what, reach, n_words = found
        out = np.zeros((len(n_words), len(self.links)))
        for i, link in enumerate(self.links):
            score = np.full(len(n_words), link.constant) + out[:, :i] @ link.earlier
            if len(link.inputs):
                at = np.minimum(np.searchsorted(link.inputs, what), len(link.inputs) - 1)
                hit = link.inputs[at] == what
                score += np.bincount(doc[hit], (link.weights[at[hit]] * reach[hit]).sum(axis=1), minlength=len(n_words))
            out[:, i] = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
        return out


def inputs_of(raw: np.ndarray, offsets: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, input, levels reached, words of each document) of the distinct inputs of each document.

    ``known``: sorted inputs; others are left out.
    """
    starts, ends, first = words(raw, offsets, _GAP)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    docs, whats = [], []
    for k in (0, *BEGINNINGS):
        use = ends - starts > k if k else np.ones(len(starts), bool)
        h, d = word_hashes(raw, starts[use], starts[use] + k if k else ends) ^ np.uint64(k), doc[use]
        if known is not None and len(known):
            hit = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
            h, d = h[hit], d[hit]
        elif known is not None:
            h, d = h[:0], d[:0]
        docs.append(d)
        whats.append(h)
    doc, what = np.concatenate(docs), np.concatenate(whats)
    order = np.lexsort((what, doc))
    doc, what = doc[order], what[order]
    new = np.flatnonzero(np.concatenate(([True], (what[1:] != what[:-1]) | (doc[1:] != doc[:-1])))) if len(what) else np.zeros(0, np.int64)
    count = np.diff(np.append(new, len(what)))
    doc, what = doc[new], what[new]
    density = count / np.maximum(n_words[doc], 20) * 1000
    reach = np.concatenate((count[:, None] >= np.array(COUNTS), density[:, None] >= np.array(DENSITIES)), axis=1)
    return doc, what, reach, n_words


def _tallies(marks: list[str]):
    """Per batch of the sample: of how many rows that have each 0/1 mark, each (input, level) is in."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in marks])
            for at, _, raw, offsets in slices(batch.column("text"), SLICE):
                doc, what, reach, _ = inputs_of(raw, offsets)
                own, inverse = np.unique(what, return_inverse=True)
                for level in range(LEVELS):
                    use = reach[:, level]
                    tally = [np.bincount(inverse[use], row[at + doc[use]], minlength=len(own)).astype(np.int64) for row in y]
                    some = np.bincount(inverse[use], minlength=len(own)) > 0
                    yield pa.RecordBatch.from_arrays([pa.array(own[some].view(np.int64)), pa.array(np.full(int(some.sum()), level, np.int32)), *(pa.array(t[some]) for t in tally)], ["what", "level", *marks])

    return run


def _vectors(known: np.ndarray, names: list[str]):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            what_, reach_, at_ = [], [], []
            for at, stop, raw, offsets in slices(batch.column("text"), SLICE):
                doc, what, reach, _ = inputs_of(raw, offsets, known)
                cut = np.searchsorted(doc, np.arange(stop - at + 1))
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    what_.append(what[a:b].tobytes())
                    reach_.append(reach[a:b].tobytes())
                at_.append(at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(batch.column(n) for n in names), pa.array(what_, pa.binary()), pa.array(reach_, pa.binary())], ["doc_id", *names, "what", "reach"])

    return run


def _fit(row: np.ndarray, column: np.ndarray, n_columns: int, dense: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on sparse 0/1 columns and dense ones, by Adam on the whole sample."""
    n, k = len(y), n_columns + dense.shape[1] + 1
    w, mean, square = np.zeros(k), np.zeros(k), np.zeros(k)
    for i in range(1, steps + 1):
        score = np.bincount(row, w[column], minlength=n) + dense @ w[n_columns:-1] + w[-1]
        wrong = 1 / (1 + np.exp(-np.clip(score, -50, 50))) - y
        grad = np.concatenate((np.bincount(column, wrong[row], minlength=n_columns), wrong @ dense, [wrong.sum()])) / max(n, 1)
        grad[:-1] += 1e-4 * w[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        w -= 0.05 * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
    return w[:n_columns], w[n_columns:-1], float(w[-1])


def _chosen(tally: DataFrame, name: str, totals: dict[str, int], outside: int, inputs: int) -> list[tuple[int, int]]:
    """(input, level) that tell rows of a category best from others, by the rows that are not in fold ``outside``."""
    folds = [f for f in range(FOLDS) if f != outside]
    of, all_ = sum(totals[f"{name}_{f}"] for f in folds), sum(totals[f"every_{f}"] for f in folds)
    of, rest = max(of, 1), max(all_ - of, 1)
    total = lambda n: sum((F.col(f"{n}_{f}") for f in folds), F.lit(0))
    p = (total("every") + 1) / F.lit(float(of + rest))
    z = F.abs(total(name) / of - (total("every") - total(name)) / rest) / F.sqrt(p * (1 - F.least(p, F.lit(0.99))) * (1 / of + 1 / rest))
    best = tally.filter(total("every") >= LEAST_ROWS).select("what", "level", z.alias("z")).orderBy(F.desc("z"), "what", "level").limit(inputs)
    return [(r["what"], r["level"]) for r in best.collect()]


def train(docs: DataFrame, labels: DataFrame, chain: tuple = CHAIN, sample: int = SAMPLE, inputs: int = INPUTS) -> Chain:
    """The chain, fitted on the documents of a sample of ``labels`` (doc_id and what ``chain`` reads).

    ``sample`` bounds the labelled documents, ``inputs`` the (input, level) pairs of each model.  Of several labels
    of one document, a category holds if any of them says so; labels with nulls and such without a document count as
    not there.  With no rows of one class a category is predicted as the other.
    """
    names = [n for n, _ in chain]
    marks = [f"{n}_{f}" for n in (*names, "every") for f in range(FOLDS)]
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.expr(f"int({sql})").alias(n) for n, sql in chain)).dropna()
    chosen = marked.groupBy("doc_id").agg(*(F.max(n).alias(n) for n in names)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = source.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int"))
    in_fold = {f"{n}_{f}": F.when(F.col("fold") == f, F.col(n) if n != "every" else F.lit(1)).otherwise(0) for n in (*names, "every") for f in range(FOLDS)}
    rows = stored(rows.withColumns(in_fold), "sample")
    totals = rows.agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in marks)).first().asDict()
    kinds = ", ".join(f"{m} long" for m in marks)
    every = sum((F.col(f"every_{f}") for f in range(FOLDS)), F.lit(0))
    tally = rows.mapInArrow(_tallies(marks), f"what long, level int, {kinds}").groupBy("what", "level").agg(*(F.sum(m).alias(m) for m in marks)).filter(every >= LEAST_ROWS)
    tally = stored(tally, "tally")
    picked = {(n, f): _chosen(tally, n, totals, f, inputs) for n in names for f in (*range(FOLDS), FOLDS)}
    known = np.unique(np.array([w for x in picked.values() for w, _ in x], np.int64).view(np.uint64))
    fields = ", ".join(f"{n} long" for n in (*names, "fold"))
    columns = [F.col(n).cast("long").alias(n) for n in (*names, "fold")]
    got = rows.select("doc_id", *columns, "text").mapInArrow(_vectors(known, [*names, "fold"]), f"doc_id long, {fields}, what binary, reach binary").collect()
    got.sort(key=lambda r: r["doc_id"])
    row = np.repeat(np.arange(len(got)), [len(r["what"]) // 8 for r in got])
    what = np.frombuffer(b"".join(r["what"] for r in got), np.uint64)
    reach = np.frombuffer(b"".join(r["reach"] for r in got), bool).reshape(-1, LEVELS)
    at = np.searchsorted(known, what)
    fold = np.array([r["fold"] for r in got], np.int64)
    out, earlier = Chain(), np.zeros((len(got), 0))
    for name in names:
        y = np.array([r[name] for r in got], float)

        def columns_of(chosen_: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """The slots of the chosen inputs, and the rows and slots of the entries of the sample."""
            slot = np.full((len(known), LEVELS), -1)
            for i, (w, level) in enumerate(chosen_):
                slot[np.searchsorted(known, np.array([w], np.int64).view(np.uint64))[0], level] = i
            column = np.where(reach, slot[at], -1)
            r_, l_ = np.nonzero(column >= 0)
            return slot, row[r_], column[r_, l_]

        apart = np.zeros(len(got))
        for f in range(FOLDS):
            _, r_, c_ = columns_of(picked[name, f])
            inside, place = fold[r_] != f, np.cumsum(fold != f) - 1
            w, v, c = _fit(place[r_[inside]], c_[inside], len(picked[name, f]), earlier[fold != f], y[fold != f])
            score = np.bincount(r_, w[c_], minlength=len(got)) + earlier @ v + c
            apart[fold == f] = 1 / (1 + np.exp(-np.clip(score[fold == f], -50, 50)))
        slot, r_, c_ = columns_of(picked[name, FOLDS])
        w, v, c = _fit(r_, c_, len(picked[name, FOLDS]), earlier, y)
        weights = np.zeros((len(known), LEVELS))
        weights[slot >= 0] = w[slot[slot >= 0]]
        out.links.append(Link(name, known, weights, v, c if len(got) else -50.0))
        earlier = np.column_stack((earlier, apart))
    own = np.flatnonzero(sum((np.abs(x.weights).sum(axis=1) for x in out.links), np.zeros(len(known))) > 0)
    for x in out.links:  # what only models of folds use is not looked up
        x.inputs, x.weights = known[own], x.weights[own]
    return out


def _probabilities(chain: Chain, column: pa.Array) -> np.ndarray:
    parts = [chain.predict(inputs_of(raw, offsets, chain.links[0].inputs)) for _, _, raw, offsets in slices(column, SLICE)]
    return np.concatenate([np.zeros((0, len(chain.links))), *parts])


def _predicted(shared):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            p = _probabilities(chain, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(p[:, i]) for i in range(p.shape[1]))], ["doc_id", *(f"p_{x.name}" for x in chain.links)])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, chain: tuple = CHAIN, limit: float = 0.5) -> DataFrame:
    """doc_id, a probability p_<category> for each category of the chain, and toxic: whether the last is at
    least ``limit``; a row for each row of ``docs`` (doc_id, text, more).

    Null, empty and blank texts have no inputs, and the probabilities of the models' constants.  Very long texts are
    read whole.  Repeated rows and null ids are rows like any other; other columns are ignored, whatever their names.
    Without labels nothing is toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, chain))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fields = [f"p_{n}" for n, _ in chain]
    found = source.mapInArrow(_predicted(shared), f"doc_id long, {', '.join(f'{f} double' for f in fields)}")
    return found.select("doc_id", *fields, (F.col(fields[-1]) >= limit).alias("toxic"))


def without_toxic(docs: DataFrame, labels: DataFrame, chain: tuple = CHAIN, limit: float = 0.5) -> DataFrame:
    """``docs``, in all its columns, without the rows that ``toxicity`` calls toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, chain))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = _probabilities(shared.value, batch.column("text"))[:, -1] < limit
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
