"""The registered queries of this subpackage and the SQL that DuckDB can check them with."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acreflow.llm import bloom_lm, cap_filters, ngram_jaccard, packing, poisson_mix, recompression, secrets, sessions, toxicity, url_filters, whitening, winnowing, wordpiece


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.poisson_mix(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_fingerprints(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_wordpiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A file of the public tokenizers; ACREFLOW_TOKENIZERS names another folder."""
    folder = os.environ.get("ACREFLOW_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_documents(table(spark, sf_dir, "documents"))


def op7_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.sessions(table(spark, sf_dir, "clicks"))


def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.without_repeats(table(spark, sf_dir, "documents"), texts=False)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_poisson_mix": op1_poisson_mix,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_toxicity": op3_toxicity,
    "op4_wordpiece": op4_wordpiece,
    "op5_packing": op5_packing,
    "op6_bloom_lm": op6_bloom_lm,
    "op7_cap_filters": op7_cap_filters,
    "op8_url_filters": op8_url_filters,
    "op9_winnowing": op9_winnowing,
    "op10_secrets": op10_secrets,
    "op11_recompression": op11_recompression,
    "op12_whitening": op12_whitening,
    "op13_gap_sessions": op13_gap_sessions,
}

ORACLE_SQL: dict[str, str] = {
    "op1_poisson_mix": poisson_mix.ORACLE_SQL,
    "op2_ngram_jaccard": ngram_jaccard.ORACLE_SQL,
    "op8_url_filters": url_filters.ORACLE_SQL,
    "op11_recompression": recompression.ORACLE_SQL,
    "op13_gap_sessions": sessions.ORACLE_SQL,
}
