"""The pipeline's stages, each on what the one before left, and the registry."""

import collections

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

import __spark_entry__  # noqa: E402
from acreflow.llm import secrets  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    words = [f"word{chr(97 + i % 26)}{i}" for i in range(400)]
    clean = [" ".join(words[(7 * i + j * (i + 3)) % 400] for j in range(40)) for i in range(80)]
    toxic = [f"{t} idiot scum idiot" for t in clean[:30]]
    texts = [*clean, *toxic, clean[3], clean[5] + " more", f"{clean[0][::-1]} token = abcdef123456", None]
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(80 <= i < 110)) for i in range(0, 110)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d, docs, seen = str(tmp_path), spark.createDataFrame(rows, DOCS), {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "secrets", "mixing", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        out.write.parquet(f"{d}/out{k}")
        docs = spark.read.parquet(f"{d}/out{k}")
        seen[name] = docs.collect()
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda n: {r["doc_id"] for r in seen[n]}
    assert not ids("toxicity") & set(range(80, 110)) and ids("toxicity") == {*range(80), 110, 111, 112, 113}
    assert ids("ngram_jaccard") == {*range(80), 112, 113}
    assert ids("secrets") == ids("ngram_jaccard") and not [r for r in seen["secrets"] if secrets.spans_of(r["text"])]
    times = collections.Counter(r["doc_id"] for r in seen["mixing"])
    assert set(times) <= ids("secrets") and 0.5 < sum(times.values()) / len(ids("secrets")) < 1.6
    packed = collections.Counter()
    for r in seen["packing"]:
        packed[r["doc_id"]] += r["length"]
    tokens = {r["doc_id"]: r["doc_tokens"] for r in seen["packing"]}
    assert packed == {i: n * tokens[i] for i, n in times.items()}
    run = corpus_pipeline.run(spark, d).collect()
    cut = lambda rows_: sorted((r["doc_id"], r["doc_tokens"]) for r in rows_ if r["start"] == 0)
    assert cut(run) == cut(seen["packing"])


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_repeated_rows_and_columns_of_any_name(spark, tmp_path):
    more = ["copy", "row", "n", "place", "spans", "component_id", "slice", "__n", "block"]
    words = [f"w{chr(97 + i % 26)}{i}" for i in range(300)]
    texts = [" ".join(words[(5 * i + j * (i + 2)) % 300] for j in range(30)) for i in range(40)]
    rows = [(i, t, "en", f"s{i % 2}", len(t), *(f"{c}{i}" for c in more)) for i, t in enumerate(texts)]
    rows += rows[:5] + [(None, "a text without an id " * 3, "en", None, 63, *more), (99, None, None, "s0", None, *more)]
    docs = spark.createDataFrame(rows, DOCS + "".join(f", `{c}` string" for c in more))
    spark.createDataFrame([(i, 1, i % 2) for i in range(0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    columns, known = docs.columns, set(rows)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        if k < 4:
            assert docs.columns == columns and docs.count() and {tuple(r) for r in docs.collect()} <= known
    assert {r["doc_id"] for r in docs.collect()} <= {r[0] for r in rows}


def test_registry():
    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names
