"""Names within an edit distance, by an index of segments.

A name that differs from another in at most k edits holds at least one of any k + 1 disjoint segments of it unchanged, at most
k places away.  So each name is cut into k + 1 even segments, and of each its rarest run of up to five characters is
put into an index; every other name looks up all its runs.  Pairs that meet in a run are verified.  No block is compared
with itself as a whole: what meets is bounded by how often the rarest runs occur.

A name has many runs, which Spark's estimate of a table's size does not count, so the joins ask for shuffles: it would
broadcast millions of runs as if they were the names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of a run at most.
GRAM = 5


def _size(length: Column, most: int) -> Column:
    """Characters of the runs that a name of some length is looked up by; 0 for one with fewer characters than segments."""
    return F.least(F.lit(GRAM), F.floor(length / (most + 1))).cast("int")


def close_pairs(names: DataFrame, most: int) -> DataFrame:
    """(block, name_a, name_b, distance) for the pairs of distinct names of one block (block, name) at most ``most`` edits apart.

    name_a is the shorter one, of equally long ones the lesser.  Rows with a null block or name pair with nothing; empty names
    are names.  Names with fewer characters than segments meet all names of their block that are short enough.
    """
    own = names.select("block", "name").filter("block is not null and name is not null").distinct().withColumn("len", F.length("name"))
    parts = most + 1
    cut = own.withColumn("q", _size(F.col("len"), most))
    at = F.explode(F.sequence(F.lit(0), F.lit(most))).alias("part")
    spots = cut.filter("q > 0").select("block", "name", "len", "q", at)
    first, last = F.floor(F.col("part") * F.col("len") / parts).cast("int"), (F.floor((F.col("part") + 1) * F.col("len") / parts) - F.col("q")).cast("int")
    runs = spots.select("block", "name", "len", "q", "part", F.explode(F.sequence(first, last)).alias("at"))
    runs = runs.withColumn("gram", F.substring(F.col("name"), F.col("at") + 1, F.col("q")))
    often = runs.groupBy("block", "gram").agg(F.count(F.lit(1)).alias("often"))
    rarest = runs.join(often.hint("merge"), ["block", "gram"]).groupBy("block", "name", "len", "part").agg(F.min(F.struct("often", "gram", "at")).alias("r"))
    short = cut.filter("q = 0").select("block", F.lit("").alias("gram"), F.col("name").alias("name_a"), F.col("len").alias("len_a"), F.lit(0).alias("at_a"))
    index = rarest.select("block", "r.gram", F.col("name").alias("name_a"), F.col("len").alias("len_a"), F.col("r.at").alias("at_a")).unionByName(short)
    # The runs of a name in all sizes that names as long or up to ``most`` shorter are indexed by.
    sizes = F.array_distinct(F.transform(F.sequence(F.greatest(F.col("len") - most, F.lit(0)), F.col("len")), lambda n: _size(n, most)))
    asked = own.select("block", "name", "len", F.explode(sizes).alias("q"))
    asked = asked.select("block", "name", "len", "q", F.explode(F.when(F.col("q") > 0, F.sequence(F.lit(0), F.col("len") - F.col("q"))).otherwise(F.array(F.lit(0)))).alias("at_b"))
    asked = asked.select("block", F.when(F.col("q") > 0, F.substring(F.col("name"), F.col("at_b") + 1, F.col("q"))).otherwise("").alias("gram"), F.col("name").alias("name_b"), F.col("len").alias("len_b"), "at_b")
    order = (F.col("len_a") < F.col("len_b")) | ((F.col("len_a") == F.col("len_b")) & (F.col("name_a") < F.col("name_b")))
    met = index.join(asked.hint("merge"), ["block", "gram"]).filter(order & (F.col("len_b") - F.col("len_a") <= most) & ((F.abs(F.col("at_a") - F.col("at_b")) <= most) | (F.col("gram") == "")))
    pairs = met.withColumn("distance", F.levenshtein("name_a", "name_b", most)).filter("distance >= 0")
    return pairs.select("block", "name_a", "name_b", "distance").distinct()
