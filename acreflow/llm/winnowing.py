"""Document fingerprints by winnowing, in DataFrame functions only.

A text's words (ASCII white space separates them, letters lower-cased) get 31-bit hashes; every run of K
words gets a polynomial (Karp-Rabin) hash modulo the prime 2**31 - 1, built for all positions at once; in
each window of W consecutive K-gram hashes the smallest is chosen, the rightmost of equal ones, and its
position is kept.  Two texts that share any W + K - 1 words in a row share a fingerprint there.

A hash and its position are one long, ``hash * 2**32 + (2**32 - 1 - position)``: the minimum of such longs
is the smallest hash with the rightmost tie, and sliding minima of width 2 and 4 make those of width 6.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from acreflow.plans.storage import input_bytes

K, W = 3, 6
PRIME = 2**31 - 1
BASE = 1_000_003
_TOP = 2**32 - 1
#: Bytes of input, as Catalyst estimates them, for one range of ids.
RANGE_BYTES = 1 << 20
#: Ranges at most: their first ids are longs in the plan.  Beyond 1 TB ranges get longer; their rows are sorted, with spill.
MAX_RANGES = 1 << 20
_SPACE = "[\\x20\\x09-\\x0D]+"


def word_list(text: Column) -> Column:
    """The text's words; the empty array for null, empty or blank text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPACE), lambda w: w != "")


def _with_next(a: str, by: int, f) -> Column:
    """f(x, y) of each entry of the array column ``a`` and the one ``by`` further on, null beyond the end.

    ``a`` must be a column and not an expression: it is read three times.
    """
    return F.zip_with(F.col(a), F.slice(F.col(a), F.lit(1 + by), F.greatest(F.size(a) - by, F.lit(0))), f)


def _first(a: str, n: Column) -> Column:
    return F.slice(F.col(a), F.lit(1), F.greatest(n, F.lit(0)))


def with_marks(df: DataFrame, text: str, to: str) -> DataFrame:
    """Adds ``to``, the chosen (hash, position) longs of ``text`` in the order of positions.

    Each step is a column of its own, so that no array is computed twice.
    """
    h, two, n, k, p, a, b, m = (f"__{to}_{x}" for x in ("h", "two", "n", "k", "p", "a", "b", "m"))
    none = F.array().cast("array<long>")
    join = lambda x, y: (x * F.lit(BASE) + y) % F.lit(PRIME)
    least = lambda x, y: F.least(x, y)
    df = df.withColumn(h, F.transform(word_list(F.col(text)), lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME))))
    # Polynomial hashes of two words, then of three: the last ones, which run over the end, are cut off.
    df = df.withColumn(n, F.greatest(F.size(h) - (K - 1), F.lit(0))).withColumn(two, _with_next(h, 1, join))
    third = F.zip_with(_first(two, F.col(n)), F.slice(F.col(h), F.lit(K), F.greatest(F.col(n), F.lit(1))), join)
    short = F.array(F.aggregate(h, F.lit(0).cast("long"), join))
    df = df.withColumn(k, F.when(F.col(n) > 0, third).when(F.size(h) > 0, short).otherwise(none))
    df = df.withColumn(p, F.transform(k, lambda x, i: x * F.lit(2**32) + (F.lit(_TOP) - i)))
    # Sliding minima of widths 2, 4 and 6; least() passes over the nulls beyond the end.
    df = df.withColumn(a, _with_next(p, 1, least)).withColumn(b, _with_next(a, 2, least)).withColumn(m, _with_next(b, 2, least))
    chosen = F.when(F.size(p) >= W, _first(m, F.size(p) - (W - 1))).when(F.size(p) > 0, F.array(F.array_min(p))).otherwise(none)
    return df.withColumn(to, F.array_distinct(chosen)).drop(h, two, n, k, p, a, b, m)


def mark_hashes(marks: Column) -> Column:
    return F.transform(marks, lambda x: F.shiftright(x, 32))


def shown(marks: Column) -> Column:
    """``hash@position`` (both hexadecimal), comma-joined."""
    return F.array_join(F.transform(marks, lambda x: F.concat(F.lower(F.hex(F.shiftright(x, 32))), F.lit("@"), F.lower(F.hex(F.lit(_TOP) - x.bitwiseAND(F.lit(_TOP)))))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two lists of hashes as sets; 1 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def fingerprint(df: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint string of ``text`` as ``to``.  Null, empty and blank text: ''.  A text
    with fewer than K words has one hash, of all its words; one with fewer than W K-grams has one choice."""
    return with_marks(df, text, "__marks").withColumn(to, shown(F.col("__marks"))).drop("__marks")


def _ranges(ids: DataFrame, n: int) -> list[int]:
    """The smallest id of each of about ``n`` ranges with about as many rows each: so many longs for the driver.

    Every k-th id of the sorted ones, found once: another sort could put its cuts elsewhere.
    """
    known = ids.filter("doc_id is not null")
    k = max(1, -(-known.count() // n))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_ = known.repartitionByRange(max(8, n >> 12), "doc_id").sortWithinPartitions("doc_id").withColumn("i", place)
    return sorted(r[0] for r in sorted_.filter(F.col("i") % k == 0).select("doc_id").distinct().collect())


def _longs(values: list[int]) -> Column:
    """A constant array, in one call whatever its length."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _range_of(id_: Column, starts: list[int]) -> Column:
    """The number of the range that holds an id, by a search in three steps of about n ** (1 / 3) comparisons."""
    step = math.ceil(len(starts) ** (1 / 3)) + 1
    upto = lambda a: F.greatest(F.size(F.filter(a, lambda s: s <= id_)) - 1, F.lit(0))
    at = upto(_longs(starts[:: step * step]))
    for every in (step, 1):
        at = at * step + upto(F.slice(_longs(starts[::every]), at * step + 1, step))
    return at.cast("int")


def edited_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text, more): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The next document is the next row in ascending (doc_id, text), the first one after the last; so repeated
    rows follow one another, and the only row of a table follows itself.  Rows with a null doc_id are left
    out of this order: they count as followed by themselves.  Null text is empty.

    One shuffle of the texts: rows are dealt into ranges of doc_id, and the first row of a range also goes,
    as a guest, to the end of the range before it.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    n = ranges or max(8, min(MAX_RANGES, input_bytes(docs.select("doc_id", "text")) // RANGE_BYTES))
    starts = _ranges(ids, int(n))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if starts:
        base = base.withColumn("own", _range_of(F.col("doc_id"), starts))
        r = F.col("own")
        before = F.when(r == 0, F.lit(len(starts) - 1)).otherwise(r - 1)
        is_first = F.get(_longs(starts), r) == F.col("doc_id")
        homes = F.when(F.col("doc_id").isNull(), F.array(F.struct(F.pmod(F.xxhash64("text"), F.lit(len(starts))).cast("int").alias("r"), F.lit(False).alias("guest")))).when(
            is_first, F.array(F.struct(r.alias("r"), F.lit(False).alias("guest")), F.struct(before.cast("int").alias("r"), F.lit(True).alias("guest")))
        ).otherwise(F.array(F.struct(r.alias("r"), F.lit(False).alias("guest"))))
    else:
        homes = F.array(F.struct(F.lit(0).alias("r"), F.lit(False).alias("guest")))
    dealt = base.select("doc_id", "text", F.inline(homes)).repartition(F.col("r"))
    marked = with_marks(dealt, "text", "marks")
    order = Window.partitionBy("r").orderBy("guest", "doc_id", "text")
    after = marked.select("doc_id", "text", "guest", "marks", *(F.lead(x).over(order).alias(f"next_{x}") for x in ("text", "marks")))
    alone = F.col("doc_id").isNull()
    own = after.filter(~F.col("guest")).withColumns({x: F.when(alone, F.col(x[5:])).otherwise(F.col(x)) for x in ("next_text", "next_marks")})
    own = own.withColumn("n_chars", F.length("text").cast("long")).withColumn("cut", F.floor(F.col("n_chars") / 4).cast("int"))
    own = own.withColumn("edited", F.concat(F.expr("substring(text, 1, int(n_chars - cut))"), F.expr("substring(next_text, 1, cut)")))
    own = with_marks(own.withColumn("near_next", likeness(mark_hashes(F.col("marks")), mark_hashes(F.col("next_marks")))).drop("next_text", "next_marks", "text"), "edited", "edited_marks")
    return own.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        shown(F.col("marks")).alias("fingerprint"),
        shown(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(mark_hashes(F.col("marks")), mark_hashes(F.col("edited_marks"))).alias("near_edited"),
        "near_next",
    )
