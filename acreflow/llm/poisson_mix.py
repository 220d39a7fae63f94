"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the mixture's characters over its own.  Each document
draws its count by inverting the Poisson distribution of that rate at a number hashed from a seed and the
document, is repeated that often, and all copies are shuffled globally by a hash of their own.  The draw needs
no state, so a lost executor repeats it exactly.  A rate above ``LARGEST`` is cut into equal parts, each drawn from a
hash of its own: their sum follows the whole rate, and no table of probabilities grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreflow.plans.storage import stored

#: A table of rates of at most so many bytes is broadcast; a larger one is joined with salted keys.
TABLE_BYTES = 16 << 20
#: The largest rate that is drawn at once.
LARGEST = 64.0
SALTS = 32
_STEPS = 2**52


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from a seed and columns: the first 13 hexadecimal digits of an MD5."""
    text = F.concat_ws(":", F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(_STEPS))


def poisson_table(rate: Column) -> Column:
    """The cumulative probabilities of 0, 1, 2 ... up to where the rest is below the draw's resolution."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    first = F.struct((-rate).alias("log"), F.exp(-rate).alias("cum"), F.array(F.exp(-rate)).alias("all"))

    def step(a: Column, k: Column) -> Column:
        log = a["log"] + F.log(rate) - F.log(k.cast("double"))
        cum = F.least(a["cum"] + F.exp(log), F.lit(1.0))
        return F.struct(log.alias("log"), cum.alias("cum"), F.concat(a["all"], F.array(cum)).alias("all"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), first, step, lambda a: a["all"])).otherwise(F.array(F.lit(1.0)))


def rates(docs: DataFrame, weights: dict[str, float] | None, power: float, size: float) -> DataFrame:
    """(source, rate) for each source of ``docs``; null is a source of its own."""
    mass = stored(docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).cast("double").alias("mass")), "mass")
    if weights is None:
        wanted = mass.withColumn("weight", F.pow(F.col("mass"), F.lit(power)))
    else:
        table = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()] or [("", 0.0)], "source string, weight double")
        wanted = mass.join(F.broadcast(table), "source", "left").fillna(0.0, ["weight"])
    sums = wanted.agg(F.sum("mass").alias("all_mass"), F.sum(F.when(F.col("mass") > 0, F.col("weight")).otherwise(0.0)).alias("all_weight"))
    all_mass, all_weight = (float(x or 0) for x in sums.first())
    share = F.col("weight") / F.lit(all_weight or 1.0) * F.lit(all_mass) * F.lit(float(size)) / F.col("mass")
    return wanted.select("source", F.when((F.col("mass") > 0) & F.lit(all_weight > 0), share).otherwise(F.lit(0.0)).alias("rate"))


def poisson_mix(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, size: float = 1.0, seed: str = "mix", numbered: bool = True) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, more), each as often as drawn, in a global random order.

    ``weights``: target share of characters by source, not necessarily adding up to 1; a source that is not
    named, null included, has none.  Without it a source's weight is its number of characters to the
    ``power``.  ``size``: characters of the mixture over those of ``docs``.  With ``numbered`` a last column
    ``copy`` (0, 1 ...) numbers the copies and takes the place of one that ``docs`` has; without it the columns are
    those of ``docs``.  Other columns come back as they are, whatever their names.  Sources without any character, and all if no weight is positive, have rate 0.  Repeated
    rows draw the same count; rows with a null doc_id draw by their text.  An empty table stays empty.
    """
    each = rates(docs.select("source", "text"), weights, power, size)
    # Rows travel as one struct, so that no name of theirs can meet one that is added here.
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    of = lambda c: F.col("row").getField(c)
    doc_id, text, source = of("doc_id"), of("text"), of("source")
    parts = F.greatest(F.ceil(F.col("rate") / F.lit(LARGEST)), F.lit(1)).cast("int")
    table = stored(each.select("source", parts.alias("parts"), poisson_table(F.col("rate") / parts).alias("cumulative")), "rates")
    own = F.when(doc_id.isNull(), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    row_bytes = F.octet_length(F.coalesce("source", F.lit(""))) + 8 * F.size("cumulative") + 64
    if (table.agg(F.sum(row_bytes)).first()[0] or 0) <= TABLE_BYTES:
        joined = whole.join(F.broadcast(table), source.eqNullSafe(F.col("source")))
    else:
        salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = whole.withColumn("own", F.pmod(F.xxhash64(doc_id, text), F.lit(SALTS)).cast("int")).join(salted, source.eqNullSafe(F.col("source")) & (F.col("own") == F.col("salt")))
    # How many entries are at most the draw: all but those before it in descending order; then the draws of further parts.
    draw = uniform(seed, doc_id, own)
    first = F.size("cumulative") - (F.array_position(F.reverse(F.array_sort(F.array_append("cumulative", draw))), draw) - 1)
    draws = F.transform(F.sequence(F.lit(1), F.col("parts") - 1), lambda j: uniform(seed, doc_id, own, j))
    further = F.aggregate(draws, F.lit(0).cast("long"), lambda n, u: n + F.size(F.filter("cumulative", lambda c: c <= u)))
    count = first + F.when(F.col("parts") > 1, further).otherwise(0)
    copies = joined.select("row", count.alias("n")).filter("n > 0").select("row", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("copy"))
    mixed = copies.withColumn("place", F.xxhash64(F.lit(seed), doc_id, "copy", text)).repartition("place").sortWithinPartitions("place")
    if not numbered:
        return mixed.select(*(of(c).alias(c) for c in docs.columns))
    return mixed.select(*(of(c).alias(c) for c in docs.columns if c != "copy"), "copy")


#: The same by DuckDB, for the defaults.
ORACLE_SQL = """
WITH RECURSIVE mass AS (SELECT source, CAST(sum(length(text)) AS DOUBLE) AS mass FROM documents GROUP BY source),
whole AS (SELECT source, sqrt(mass) / (SELECT sum(sqrt(mass)) FROM mass) * (SELECT sum(mass) FROM mass) / mass AS rate FROM mass),
rates AS (SELECT source, rate / greatest(ceil(rate / 64e0), 1e0) AS rate, CAST(greatest(ceil(rate / 64e0), 1e0) AS INTEGER) AS parts FROM whole),
steps AS (
  SELECT source, rate, 0 AS k, -rate AS l, exp(-rate) AS cum FROM rates
  UNION ALL
  SELECT source, rate, k + 1, l + ln(rate) - ln(CAST(k + 1 AS DOUBLE)), least(cum + exp(l + ln(rate) - ln(CAST(k + 1 AS DOUBLE))), 1e0)
  FROM steps WHERE k < ceil(rate + 10e0 * sqrt(rate) + 20e0)
),
part AS (SELECT d.*, unnest(range(r.parts)) AS j FROM documents d JOIN rates r ON r.source = d.source),
draws AS (
  SELECT doc_id, text, lang, source, n_chars, j,
         CAST(CAST('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR) || ':\\N' || CASE WHEN j > 0 THEN ':' || CAST(j AS VARCHAR) ELSE '' END), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496e0 AS u
  FROM part
),
counts AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) AS n FROM draws d JOIN steps s ON s.source = d.source AND s.cum <= d.u GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(n)) AS INTEGER) AS copy FROM counts
"""
