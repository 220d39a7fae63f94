"""Reconciling duplicate entities: exact copies, close names, near copies of texts, canonical records."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreflow.functions.columns import digest
from acreflow.operators.components import connected_components
from acreflow.operators.segments import close_pairs
from acreflow.plans.storage import forget, stored

#: How often texts that are not joined yet stand for their shingles, at most: moves work, never a result.
TURNS = 6


def unify(*frames: DataFrame) -> DataFrame:
    """Rows of one kind of entity from several sources; columns that a source lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def exact_classes(df: DataFrame, key: str, *content: str) -> DataFrame:
    """content_sha256, least key and number of rows for each distinct content."""
    return df.groupBy(digest(*(F.col(c) for c in content)).alias("content_sha256")).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("n_rows"))


def close_names(df: DataFrame, key: str, name: Column, block: Column, most: int) -> DataFrame:
    """(a, b, distance) links between the representatives of equal names that share a block.

    Names are compared once for all rows that have them; links come between their smallest keys.  Within a block names meet
    through an index of their segments (``segments.close_pairs``).  Null names or blocks link nothing.  No join is a broadcast:
    compressed files make tables of names look smaller than they are.
    """
    rows = df.select(F.col(key).alias("k"), name.alias("name"), block.alias("block")).filter("name is not null and block is not null")
    own = rows.groupBy("block", "name").agg(F.min("k").alias("k"))
    end = lambda x: own.select("block", F.col("name").alias(f"name_{x}"), F.col("k").alias(x))
    pairs = close_pairs(rows, most).join(end("a").hint("merge"), ["block", "name_a"]).join(end("b").hint("merge"), ["block", "name_b"])
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")


def _shared_shingles(df: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """(k, n, central, set), stored: of each different text that can link its number of shingles and those of several
    texts, rarest first; central is how often these occur, in all."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    own = df.groupBy(F.sha2(F.col(text), 256).alias("h")).agg(F.min(key).alias("k"), F.first(text).alias(text)).filter("h is not null")
    own = own.filter(F.col(text).rlike(r"[^\x20\x09-\x0D]")).select("k", words.alias("w"))  # cheap enough to be done before the words
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, F.lit(width))))
    sets = own.select("k", F.sort_array(F.array_distinct(runs)).alias("set")).withColumn("n", F.size("set"))
    sets = stored(sets, "sets")
    # Linked texts share the first of their smallest n - least + n / 10 shingles: as many as a tenth of the smaller text, which has least.
    some = sets.select("k", "n", F.explode(F.slice("set", F.lit(1), F.col("n") - _least(percent) + F.ceil(F.col("n") / 10).cast("int"))).alias("s"))
    shares = some.join(_several(some), "s").groupBy("k", "n").agg(F.count(F.lit(1)).alias("m")).filter(10 * F.col("m") >= _least(percent)).select("k")
    entries = sets.join(shares.hint("merge"), "k").select("k", "n", F.explode("set").alias("s"))
    held = entries.join(_several(entries), "s").repartition("k").groupBy("k").agg(F.first("n").alias("n"), F.sum("f").alias("central"), F.sort_array(F.collect_list(F.struct("f", "s"))).alias("held"))
    rows = stored(held.filter(F.size("held") >= _least(percent)).select("k", "n", "central", F.transform("held", lambda x: x.s).alias("set")), "shared")
    forget(sets)
    return rows


def _several(entries: DataFrame) -> DataFrame:
    """(s, f) of the shingles of several texts."""
    return entries.groupBy("s").agg(F.count(F.lit(1)).alias("f")).filter("f > 1").hint("merge")


def _least(percent: int) -> Column:
    """What a text of n shingles must share with any that it links to."""
    return F.ceil(F.col("n") * percent / 100).cast("int")


def _ranked(rows: DataFrame, percent: int) -> DataFrame:
    """(k, n, central, s, rest): the rarest shingles of each text, as many as two linked texts cannot both lack; rest counts
    those from there on."""
    prefix = F.slice("set", F.lit(1), F.size("set") - _least(percent) + 1)  # shingles of one text only are the rarest, and come before
    return rows.select("k", "n", "central", F.size("set").alias("size"), F.posexplode(prefix).alias("i", "s")).withColumn("rest", F.col("size") - F.col("i")).drop("size", "i")


def _able(percent: int) -> Column:
    """Whether enough shingles follow in both for two texts that meet to link."""
    return (100 + percent) * F.least("rest_a", "rest_b") >= percent * (F.col("n_a") + F.col("n_b"))


def _linked(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, overlap, n_a, n_b) of those of ``pairs`` that link, counted out on what the texts share with any."""
    whole = lambda x: rows.select(F.col("k").alias(x), F.col("n").alias(f"n_{x}"), F.col("set").alias(f"set_{x}")).hint("merge")
    met = pairs.join(whole("a"), "a").join(whole("b"), "b").withColumn("overlap", F.size(F.array_intersect("set_a", "set_b")))
    return met.filter((100 + percent) * F.col("overlap") >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b", "overlap", "n_a", "n_b")


def shingle_links(df: DataFrame, key: str, text: str, width: int = 5, percent: int = 80) -> DataFrame:
    """(a, b, overlap, n_a, n_b) links between the representatives of equal texts at a Jaccard similarity of
    ``percent`` or more of their distinct word shingles; a < b.

    Texts of whose shingles too few are in several texts are dropped, first by a part of their shingles: they cannot link.  Of the others
    the rarest shingles, as many as two linked texts cannot both lack, look for partners, and two meet only if enough
    shingles follow in both; these are then counted out on what the texts share with any.  Texts with fewer words than
    ``width`` have one shingle.
    """
    rows = _shared_shingles(df, key, text, width, percent)
    ranked = _ranked(rows, percent)
    end = lambda x: ranked.select("s", F.col("k").alias(x), F.col("n").alias(f"n_{x}"), F.col("rest").alias(f"rest_{x}"))
    pairs = end("a").join(end("b").hint("merge"), "s").filter((F.col("a") < F.col("b")) & _able(percent)).select("a", "b").distinct()
    return _linked(pairs, rows, percent)


def spanning_links(df: DataFrame, key: str, text: str, width: int = 5, percent: int = 80) -> DataFrame:
    """(a, b), a < b: links of ``shingle_links`` that join the same texts, directly or not, but not all pairs of a group.

    Each text is first compared with one other: of those that stand for its rarest shingles, the one that most of these
    name.  First the most central text of a shingle stands for it, then others, as long as that joins many.  Then all texts
    meet that share such a shingle and are not joined yet, so no link between different groups is lost.
    """
    rows = _shared_shingles(df, key, text, width, percent)
    # Sizes of linked texts are of one grade or of two in a row.
    grade = F.floor(F.log("n") / F.lit(max(1.001 * math.log(100 / percent), 0.01))).cast("int")
    ranked = stored(_ranked(rows, percent).withColumn("grade", grade), "ranked")
    many, out, mixed = rows.count() / 64, [], ranked.withColumn("c", F.col("k"))
    for turn in range(TURNS):
        weight = F.xxhash64("k", F.lit(turn)) if turn else F.col("central")
        hub = mixed.groupBy("s", "grade").agg(F.max(F.struct(weight.alias("weight"), "k", "n", "rest", "c")).alias("x"))
        hub = hub.select("s", "grade", *(F.col(f"x.{c}").alias(b) for c, b in (("k", "b"), ("n", "n_b"), ("rest", "rest_b"), ("c", "c_b"))))
        near = mixed.select("s", "grade", F.col("k").alias("a"), F.col("n").alias("n_a"), F.col("rest").alias("rest_a"), F.col("c").alias("c_a")).join(hub.hint("merge"), ["s", "grade"])
        votes = near.filter(_able(percent) & (F.col("c_a") != F.col("c_b"))).groupBy("a", "b").agg(F.count(F.lit(1)).alias("votes"))
        best = votes.groupBy("a").agg(F.max(F.struct("votes", "b")).alias("x")).select(F.least("a", "x.b").alias("a"), F.greatest("a", "x.b").alias("b")).distinct()
        out.append(stored(_linked(best, rows, percent).select("a", "b"), "links"))
        found = connected_components(unify(*out), "a", "b").select(F.col("node").alias("k"), F.col("component").alias("c"))
        joined = ranked.join(found, "k", "left").withColumn("c", F.coalesce("c", "k"))
        apart = joined.groupBy("s").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("s")
        last, mixed = mixed, stored(joined.join(apart.hint("merge"), "s"), "mixed")
        if turn:
            forget(last)
        if out[-1].count() < many:
            break
    end = lambda x, *more: mixed.select("s", *more, *(F.col(c).alias(b) for c, b in (("k", x), ("n", f"n_{x}"), ("rest", f"rest_{x}"), ("c", f"c_{x}"), ("grade", f"grade_{x}"))))
    both = end("a", "grade").join(end("b", F.explode(F.array("grade", F.col("grade") + 1)).alias("grade")).hint("merge"), ["s", "grade"])
    once = (F.col("grade_a") != F.col("grade_b")) | (F.col("a") < F.col("b"))
    pairs = both.filter(_able(percent) & (F.col("c_a") != F.col("c_b")) & once).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    out.append(stored(_linked(pairs, rows, percent).select("a", "b"), "links"))
    forget(rows, ranked, mixed)
    return unify(*out)


def clusters(df: DataFrame, key: str, links: DataFrame, content: str) -> DataFrame:
    """(key, cluster_id): rows of equal ``content`` or linked ones, directly or not; the smallest key of each."""
    classes = df.groupBy(F.sha2(F.col(content), 256).alias("__h")).agg(F.min(key).alias("__rep"))
    own = df.select(F.col(key), F.sha2(F.col(content), 256).alias("__h")).join(classes, "__h", "left").select(key, F.coalesce("__rep", key).alias("__rep"))
    found = connected_components(links, "a", "b").select(F.col("node").alias("__rep"), "component")
    return own.join(found, "__rep", "left").select(key, F.coalesce("component", "__rep").alias("cluster_id"))


def canonical(members: DataFrame, cluster: str, key: str, completeness: Column, collected_at: str | None = None) -> DataFrame:
    """The row of each cluster that stands for it: most complete, then latest, then smallest key."""
    order = [completeness.desc_nulls_last(), *([F.col(collected_at).desc_nulls_last()] if collected_at else []), F.col(key).asc()]
    return members.withColumn("__r", F.row_number().over(Window.partitionBy(cluster).orderBy(*order))).filter("__r = 1").drop("__r")


def reconcile_report(mapping: DataFrame, kind: str, canonical_id: str) -> DataFrame:
    """entity_kind, n_records, n_entities, n_merged: counts before and after."""
    out = mapping.groupBy(kind).agg(F.count(F.lit(1)).alias("n_records"), F.countDistinct(canonical_id).alias("n_entities"))
    return out.withColumn("n_merged", F.col("n_records") - F.col("n_entities"))


def load_gap(source: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Keys that a source has and the loaded table has not."""
    return source.select(key).distinct().join(loaded.select(key), key, "left_anti")
