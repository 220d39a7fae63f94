"""A training-corpus pipeline of five stages, each stored before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acreflow.llm import ngram_jaccard, packing, poisson_mix, secrets, toxicity
from acreflow.llm.queries import table, tokenizer_path
from acreflow.plans.storage import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on the labelled ones, calls toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate documents the one with the smallest id stays."""
    return ngram_jaccard.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; every document stays."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share asks for, in a global random order."""
    return poisson_mix.poisson_mix(docs, numbered=False)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences that the documents make up."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: No SQL: the stages fit a classifier, search near copies and tokenize.  Tests hold them against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
