"""Why a row is in an answer, in words, from what the row itself holds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _said(*parts: Column | str) -> Column:
    """The parts put together; null if one of them is."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


#: Column of an answer -> what it says of the row.
FACTS: dict[str, Callable[[Column], Column]] = {
    "acreage": lambda c: _said(c, " acres"),
    "n_parcels": lambda c: _said(c, " adjacent parcels of one owner"),
    "n_unknown": lambda c: F.when(c > 0, _said(c, " of them of unknown size")),
    "last_transfer": lambda c: _said("last recorded transfer on ", c),
    "n_transfers": lambda c: F.when(c == 0, F.lit("no recorded transfer")).otherwise(_said(c, " recorded transfers")),
    "roof_date": lambda c: _said("roof of ", c),
    "owner_area": lambda c: _said("owner: ", c),
    "basis": lambda c: F.when(F.size(c) > 0, F.array_join(c, ", ")),
    "water_basis": lambda c: _said("view of water by ", c),
    "score": lambda c: _said("score ", F.format_number(c, 3)),
    "missing": lambda c: F.when(F.size(c) > 0, _said("not known: ", F.array_join(c, ", "))),
}


def explained(answer: DataFrame) -> DataFrame:
    """``answer`` with ``explanation``: the facts that its columns hold of each row, in the order of ``FACTS``, null ones left out.

    Columns that are not there, or not of the kind that a fact needs, say nothing; an answer with none has empty ones.
    """
    kinds = dict(answer.dtypes)
    lists = ("basis", "missing")
    facts = [fact(F.col(c)) for c, fact in FACTS.items() if c in kinds and kinds[c].startswith("array") == (c in lists)]
    return answer.withColumn("explanation", F.array_join(F.array_compact(F.array(*facts)), "; ") if facts else F.lit(""))
