"""Which records are one entity, by weights learned from the records themselves.

Pairs that may match come from sorted neighbourhoods: by each of several keys records are put in a global order, and each
meets the few that follow it under the same key, so the number of pairs follows the number of records, however many
share a key.  A pair's agreement pattern says for each field how well both agree.  Spark counts the patterns, and those of
chance pairs, neighbours in the order of a hash.  How likely each level of agreement is among pairs that do not match is read
off the latter; among matches it is fitted to the counts by expectation-maximisation, fields taken as independent (so of
fields that change together only one should be named).  Likely pairs are links, entities their connected components.

Records meet in shuffles only: estimates from compressed files and exploded rows are far too low, and tables that are broadcast
by them do not fit into the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreflow.operators.components import connected_components
from acreflow.operators.ranking import positions
from acreflow.operators.reconcile import close_names
from acreflow.plans.storage import stored

#: How many records behind it a record meets by each key.
WIDTH = 10
#: The least probability of a link.
LIKELY = 0.95


@dataclass(frozen=True)
class Field:
    """A field to compare: equal or not, or with ``edits`` equal (2), that many edits apart (1) or neither (0).  ``initials``:
    names in words that agree but for words cut to their first letter count as 1 too."""

    name: str
    edits: int = 0
    initials: bool = False

    @property
    def levels(self) -> int:
        return 3 if self.edits or self.initials else 2

    def agreement(self, a: Column, b: Column) -> Column:
        """The level of agreement; null where either is missing."""
        if self.levels == 2:
            return F.when(a.isNotNull() & b.isNotNull(), (a == b).cast("int"))
        near = F.levenshtein(a, b, self.edits) >= 0 if self.edits else F.lit(False)
        return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, 2).when(near | (_shortened(a, b) if self.initials else F.lit(False)), 1).otherwise(0))


def _shortened(a: Column, b: Column) -> Column:
    """Whether the words of two names, each in order, differ only where one of both is a single letter that begins the other."""
    x, y = F.split(a, " "), F.split(b, " ")
    alike = lambda p, q: (p == q) | ((F.length(p) == 1) & q.startswith(p)) | ((F.length(q) == 1) & p.startswith(q))
    return (F.size(x) == F.size(y)) & F.forall(F.zip_with(x, y, lambda p, q: F.coalesce(alike(p, q), F.lit(False))), lambda z: z)


def word_key(name: Column, drop: Sequence[str] = ("JR", "SR", "II", "III")) -> Column:
    """A name's words in alphabetical order, upper case and without ``drop``; null if none is left."""
    words = F.filter(F.split(F.trim(F.regexp_replace(F.upper(name), "[^A-Z0-9]+", " ")), " "), lambda w: (w != "") & ~w.isin(*drop))
    return F.nullif(F.array_join(F.array_sort(words), " "), F.lit(""))


def longest_word(words: Column) -> Column:
    """The longest word of a ``word_key``, of equally long ones the first."""
    return F.element_at(F.array_sort(F.split(words, " "), lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0)), 1)


def neighbours(df: DataFrame, key: str, by: Column, tie: Column, width: int = WIDTH) -> DataFrame:
    """(a, b), a < b: records whose places in the order of (``by``, ``tie``, ``key``) are at most ``width`` apart and that share ``by``."""
    rows = df.select(F.col(key).alias("k"), by.alias("by"), tie.alias("tie")).filter("by is not null")
    placed = positions(rows, F.asc("by"), F.asc_nulls_first("tie"), F.asc("k")).select("k", "by", "position")
    ahead = placed.select(F.col("k").alias("k2"), F.col("by").alias("by2"), F.explode(F.sequence(F.col("position") + 1, F.col("position") + width)).alias("position"))
    met = placed.join(ahead.hint("merge"), "position").filter("by = by2 and k <> k2")
    return met.select(F.least("k", "k2").alias("a"), F.greatest("k", "k2").alias("b"))


def candidates(df: DataFrame, key: str, keys: Sequence[tuple[Column, Column]], width: int = WIDTH, close: Column | None = None, edits: int = 2) -> DataFrame:
    """(a, b) of all neighbourhoods, once each; ``keys``: what records have to share, and what they are ordered by beside it.

    ``close``: texts whose least records meet too where the texts are at most ``edits`` apart, whatever else they share.
    """
    out = None
    if close is not None:
        out = close_names(df, key, close, F.lit(""), edits).select("a", "b")
    for by, tie in keys:
        found = neighbours(df, key, by, tie, width)
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def patterns(df: DataFrame, key: str, pairs: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """(a, b, one level of agreement for each field) of pairs (a, b) of rows of ``df``."""
    end = lambda x: df.select(F.col(key).alias(x), *(F.col(f.name).alias(f"{f.name}_{x}") for f in fields))
    both = pairs.join(end("a").hint("merge"), "a").join(end("b").hint("merge"), "b")
    return both.select("a", "b", *(f.agreement(F.col(f"{f.name}_a"), F.col(f"{f.name}_b")).alias(f.name) for f in fields))


def pattern_counts(compared: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Each pattern with the number of its pairs; at most the product of (levels + 1) rows."""
    return compared.groupBy(*(f.name for f in fields)).agg(F.count(F.lit(1)).alias("n_pairs"))


@dataclass(frozen=True)
class Weights:
    """How likely each level is among matches (m) and others (u), by field, and the share of matches among the pairs."""

    m: list[np.ndarray]
    u: list[np.ndarray]
    share: float

    def bits(self) -> list[np.ndarray]:
        """What each level is worth, as the binary logarithm of its odds."""
        return [np.log2(m / u) for m, u in zip(self.m, self.u, strict=True)]

    def probability(self, fields: Sequence[Field]) -> Column:
        """That a pair with these levels matches; missing fields say nothing."""
        total = F.lit(float(np.log2(self.share / (1 - self.share))))
        for f, bits in zip(fields, self.bits(), strict=True):
            worth = F.element_at(F.array(*(F.lit(float(x)) for x in bits)), F.col(f.name) + 1)
            total = total + F.when(F.col(f.name).isNull(), F.lit(0.0)).otherwise(worth)
        return F.lit(1.0) / (1 + F.pow(F.lit(2.0), -total))


def fit(counts: Sequence[tuple], fields: Sequence[Field], rounds: int = 500, settled: float = 1e-9, chance: Sequence[tuple] = ()) -> Weights:
    """Weights from (level or None by field ..., number of pairs).  No pairs leave the first guess as it is.

    ``chance``: such counts of pairs met by chance, which fix what is expected of pairs that do not match; without any this is
    fitted too.
    """
    levels = [f.levels for f in fields]
    m = [np.array([0.1 / (k - 1)] * (k - 1) + [0.9]) for k in levels]
    u = [np.array([0.9] + [0.1 / (k - 1)] * (k - 1)) for k in levels]
    share = 0.2
    if chance:
        u = [np.array([sum(c[-1] for c in chance if c[i] == level) + 0.5 for level in range(k)], float) for i, k in enumerate(levels)]
        u = [x / x.sum() for x in u]
    n = np.array([c[-1] for c in counts], float)
    if not n.sum():
        return Weights(m, u, share)
    seen = [np.array([-1 if c[i] is None else c[i] for c in counts]) for i in range(len(fields))]
    for _ in range(rounds):
        log = np.zeros((2, len(n)))
        for i, at in enumerate(seen):
            there = at >= 0
            log[0, there] += np.log(m[i][at[there]])
            log[1, there] += np.log(u[i][at[there]])
        likely = 1 / (1 + np.exp(np.clip(log[1] - log[0] + np.log((1 - share) / share), -700, 700)))
        before, share = share, float(np.clip((n * likely).sum() / n.sum(), 1e-6, 1 - 1e-6))
        moved = abs(share - before)
        for i, at in enumerate(seen):
            for table, weight in ((m, n * likely), (u, n * (1 - likely)))[: 1 if chance else 2]:
                new = np.array([weight[at == k].sum() for k in range(levels[i])]) + 1e-3  # no level is impossible
                new /= new.sum()
                moved = max(moved, float(np.abs(new - table[i]).max()))
                table[i] = new
        if moved < settled:
            break
    return Weights(m, u, share)


def links(compared: DataFrame, fields: Sequence[Field], weights: Weights, likely: float = LIKELY) -> DataFrame:
    """(a, b, score): the pairs that match with at least this probability."""
    return compared.withColumn("score", weights.probability(fields)).filter(F.col("score") >= likely).select("a", "b", "score")


def resolve(df: DataFrame, kind: str, key: str, fields: Sequence[Field], keys: Sequence[tuple[Column, Column]], likely: float = LIKELY, width: int = WIDTH, close: Column | None = None) -> tuple[DataFrame, Weights]:
    """(entities, weights) of ``df``, whose ``key`` is unique.

    entities: entity_kind, record_key, canonical_id (the least key of its component), match_rule (``weights``, or ``self``
    for a record alone), score (the greatest probability of its links; 1 alone), like ``links.entity_map``.  Null keys are
    left out.  ``fields`` name columns of ``df``; ``keys`` and ``close`` are those of ``candidates``.
    """
    rows = df.filter(F.col(key).isNotNull())
    compared = stored(patterns(rows, key, candidates(rows, key, keys, width, close), fields), "patterns")
    counts = pattern_counts(compared, fields).collect()  # one row for each pattern
    by_chance = pattern_counts(patterns(rows, key, neighbours(rows, key, F.lit(0), F.xxhash64(key), width), fields), fields).collect()
    weights = fit(sorted((tuple(r) for r in counts), key=str), fields, chance=[tuple(r) for r in by_chance])
    found = stored(links(compared, fields, weights, likely), "links")
    groups = connected_components(found, "a", "b").select(F.col("node").alias("k"), "component")
    best = found.select(F.col("a").alias("k"), "score").unionByName(found.select(F.col("b").alias("k"), "score")).groupBy("k").agg(F.max("score").alias("score"))
    own = rows.select(F.col(key).alias("k")).join(groups.hint("merge"), "k", "left").join(best.hint("merge"), "k", "left")
    return own.select(
        F.lit(kind).alias("entity_kind"), F.col("k").cast("string").alias("record_key"), F.coalesce("component", "k").cast("string").alias("canonical_id"),
        F.when(F.col("component").isNotNull(), "weights").otherwise("self").alias("match_rule"), F.coalesce("score", F.lit(1.0)).alias("score"),
    ), weights
