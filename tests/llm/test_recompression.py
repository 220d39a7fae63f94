"""Removal of repeated windows against a plain search for every window, and what recompression promises about symbols."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from acreflow.llm import recompression as R

SCHEMA = "doc_id long, text string"


def plain(rows, width=R.WINDOW):
    """Every window looked up among all windows."""
    docs = [(i, [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for i, t, *_ in rows]
    least = {}
    key = lambda i: (i is None, i or 0)
    for i, w in docs:
        for s in range(len(w) - width + 1):
            run = tuple(w[s : s + width])
            least[run] = min(least.get(run, (key(i), s)), (key(i), s))
    out = []
    for i, w in docs:
        gone = set()
        for s in range(len(w) - width + 1):
            if least[tuple(w[s : s + width])] < (key(i), s):
                gone |= set(range(s, s + width))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in R.without_repeats(df, texts=False, **more).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def corpus(seed, n, vocabulary, longest):
    """Texts that share passages of all lengths, some of them periodic, some with long runs of one word."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["Über", "über", "a", "b"]) if rng.random() < 0.05 else f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(k)] for k in (19, 20, 21, 25, 60, 200)] + [["la"] * 45, ["x", "y"] * 25, ["p"] * 19 + ["q"]]
    out = []
    for i in range(n):
        text = []
        while len(text) < rng.randrange(longest):
            text += [word() for _ in range(rng.randrange(30))]
            if rng.random() < 0.6:
                p = rng.choice(passages)
                a = rng.randrange(max(1, len(p) - 15))
                text += p[a : a + rng.randrange(15, len(p) + 2)]
        out.append((i * 3, rng.choice([" ", "\n", "\t  "]).join(text)))
    return out + [(1000 + i, t) for i, (_, t) in enumerate(rng.sample(out, n // 5))]


@pytest.mark.parametrize(("seed", "n", "vocabulary", "bits", "size"), [(1, 60, 5000, 3, 1 << 14), (2, 40, 3, 1, 1 << 12), (3, 40, 40, 0, 1 << 22)])
def test_against_every_window(spark, seed, n, vocabulary, bits, size):
    rows = corpus(seed, n, vocabulary, 300)
    assert found(spark, rows, block_bits=bits, slice_bytes=size) == plain(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(5, long), (5, long), (None, long), (None, None), (7, ""), (8, " \n\t"), (9, "one two"), (3, "zero " + long), (10, long.replace("w49", "W49")), (11, " ".join(["same"] * 400)), (12, " " + long)]
    assert found(spark, rows, block_bits=2) == plain(rows)
    assert found(spark, []) == []
    df = spark.createDataFrame([(1, long, 2, "x")], "doc_id int, text string, slice int, kind string")
    assert [r["text"] for r in R.without_repeats(df).collect()] == [long]


def test_other_widths_and_texts(spark):
    rows = [(1, "a b c d e f"), (2, "x a b c y"), (3, "c d e f"), (4, "a b c a b c")]
    got = R.without_repeats(spark.createDataFrame(rows, SCHEMA), width=3).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {1: "a b c d e f", 2: "x y", 3: "", 4: ""}


def test_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(R, "PIECE", 64)
    rng = random.Random(5)
    w = [f"w{rng.randrange(30)}" for _ in range(1500)]
    at = R.exact_hashes(*_words(" ".join(w)))
    edge = np.zeros(len(at), bool)
    edge[0] = True
    whole = _by_window(R.stand_ins(at, edge, np.arange(len(at) - 19), 20))
    parts = {}
    for base, end, starts in R._pieces(np.arange(len(at) - 19), 20):
        cut = edge[base:end].copy()
        cut[0] = True
        parts |= {p + base: k for p, k in _by_window(R.stand_ins(at[base:end], cut, starts, 20)).items()}
    assert parts == whole


def _words(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = R.textblocks.words(raw, np.array([0, len(raw)]))
    return raw, starts, ends


def _by_window(found_):
    return {p: k for k, a, n in zip(*(x.tolist() for x in found_), strict=True) for p in range(a, a + n)}


@pytest.mark.parametrize("vocabulary", [2, 3, 50, 3000])
def test_equal_windows_have_equal_symbols(vocabulary):
    """Whatever stands around a window, the same symbol stands for it; and mostly one of many words does."""
    rng = np.random.default_rng(vocabulary)
    window = rng.integers(0, vocabulary, 20)
    keys, named = set(), 0
    for _ in range(60):
        before, behind = rng.integers(0, vocabulary, rng.integers(0, 40)), rng.integers(0, vocabulary, rng.integers(0, 40))
        every = R.mix(np.concatenate([before, window, behind]).astype(np.uint64) + np.uint64(1))
        edge = np.zeros(len(every), bool)
        edge[0] = True
        keys.add(_by_window(R.stand_ins(every, edge, np.arange(len(every) - 19), 20))[len(before)])
    assert len(keys) == 1
    if vocabulary > 10:
        every = R.mix(rng.integers(0, vocabulary, 5000).astype(np.uint64))
        edge = np.zeros(5000, bool)
        edge[::500] = True
        starts = np.array([p for p in range(5000 - 19) if p // 500 == (p + 19) // 500])
        named = np.mean([k != 0 for k in _by_window(R.stand_ins(every, edge, starts, 20)).values()])
        assert named > 0.99
        for _, low, high in R.levels(every, edge):
            assert (np.diff(low) >= 0).all() and (np.diff(high) >= 0).all()


def test_sql(spark, tmp_path):
    rows = corpus(7, 30, 200, 200)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    got = con.execute(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({R.ORACLE_SQL})").fetchall()
    assert sorted(got, key=str) == plain(rows)
