"""Blocks of files against a plain builder and published identifiers; close names against all pairs."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from acreflow.functions.content_id import identifier
from acreflow.operators.segments import close_pairs
from acreflow.sources import artifacts as A


def test_published_identifiers():
    """An empty raw block, and the link node of an empty folder."""
    raw = lambda b: identifier(A.RAW, hashlib.sha256(b).digest())
    assert raw(b"") == "bafkreihdwdcefgh4dqkjv67uzcmw7ojee6xedzdetojuzjevtenxquvyku"
    folder = A.field(1, A.field(1, 1))
    assert identifier(A.LINKS, hashlib.sha256(folder).digest()) == "bafybeiczsscdsbs7ffqz55asqdf3smv6klcw3gofszvwlyarci47bgf354"
    assert [A.varint(n) for n in (0, 127, 128, 300)] == [b"\0", b"\x7f", b"\x80\x01", b"\xac\x02"]


def plain(data, chunk, fan):
    """(levels of (number of links, identifier, file bytes)), from the chunks up, one list after the other."""
    nodes = [(0, A.RAW + hashlib.sha256(c).digest(), len(c), len(c)) for c in (data[i : i + chunk] for i in range(0, max(len(data), 1), chunk))]
    levels = [nodes]
    while len(nodes) > 1:
        above = []
        for i in range(0, len(nodes), fan):
            own = nodes[i : i + fan]
            links = b""
            for _, cid, size, total in own:
                link = b"\x0a\x24" + cid + b"\x12\x00\x18" + A.varint(total)
                links += b"\x12" + A.varint(len(link)) + link
            meta = b"\x08\x02\x18" + A.varint(sum(n[2] for n in own)) + b"".join(b"\x20" + A.varint(n[2]) for n in own)
            block = links + b"\x0a" + A.varint(len(meta)) + meta
            above.append((len(own), A.LINKS + hashlib.sha256(block).digest(), sum(n[2] for n in own), len(block) + sum(n[3] for n in own)))
        nodes = above
        levels.append(nodes)
    return levels


def test_blocks_equal_plain_ones(spark, tmp_path):
    r = random.Random(1)
    sizes = {"empty": 0, "one byte": 1, "chunk": 64, "more": 65, "fan": 64 * 5, "fan and one": 64 * 5 + 1, "deep": 64 * 5**3 + 17, "ünï": 1000}
    for name, n in sizes.items():
        (tmp_path / name).write_bytes(r.randbytes(n))
    nodes, files = A.blocks(spark, str(tmp_path), 64, 5)
    got = {}
    for x in nodes.collect():
        got.setdefault(x["path"].rsplit("/", 1)[1], {})[x["level"], x["i"]] = (x["n_links"], x["cid"], x["size"], x["total"], x["root"])
    found = {x["path"].rsplit("/", 1)[1]: x for x in files.collect()}
    del sizes["empty"]  # Spark lists no empty files
    assert set(got) == set(found) == set(sizes)
    for name in sizes:
        data = (tmp_path / name).read_bytes()
        levels = plain(data, 64, 5)
        want = {(k, i): (n, identifier(cid[:4], cid[4:]), size, total, len(level) == 1) for k, level in enumerate(levels) for i, (n, cid, size, total) in enumerate(level)}
        assert got[name] == want, name
        f = found[name]
        assert (f["n_bytes"], f["sha256"], f["n_blocks"]) == (len(data), hashlib.sha256(data).hexdigest(), len(want)) and f["cid"] == want[len(levels) - 1, 0][1]
    rows = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content").mapInArrow(A._chunks(64), A._BLOCK)
    streamed = spark.read.format("binaryFile").load(str(tmp_path)).select("path").mapInArrow(A._chunks(64), A._BLOCK)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, streamed.collect()))


def test_a_file_is_streamed(tmp_path):
    """Memory does not grow with the file."""
    import tracemalloc

    import pyarrow as pa

    path = tmp_path / "large"
    with open(path, "wb") as f:
        f.truncate(64 << 20)
    tracemalloc.start()
    rows = sum(b.num_rows for b in A._chunks(A.CHUNK_BYTES)(iter([pa.RecordBatch.from_arrays([pa.array([str(path)])], ["path"])])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 257 and peak < 4 << 20


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [1, 3])
def test_close_pairs_equal_all_pairs(spark, most):
    r = random.Random(most)
    names = {("b", "".join(r.choice("abc") for _ in range(r.randrange(14)))) for _ in range(150)}
    for _ in range(120):
        w = list(r.choice(sorted(names))[1])
        for _ in range(r.randrange(1, 5)):
            p = r.randrange(len(w) + 1)
            w[p : p + r.randrange(2)] = [r.choice("abcé")] * r.randrange(2)
        names.add(("b", "".join(w)))
    names |= {("c", n) for _, n in r.sample(sorted(names), 20)}
    df = spark.createDataFrame([*names, *list(names)[:9], (None, "x"), ("b", None)], "block string, name string")
    want = {(p, *sorted((a, b), key=lambda n: (len(n), n)), distance(a, b)) for p, a in names for q, b in names if p == q and a < b and distance(a, b) <= most}
    assert {tuple(x) for x in close_pairs(df, most).collect()} == want and len(want) > 100


def test_a_large_block_does_not_meet_as_a_whole(spark):
    """20,000 names of one block: far fewer pairs meet than its 2 x 10**8."""
    r = random.Random(3)
    names = [("b", "".join(r.choice("abcdefghijklmnopqrst") for _ in range(16))) for _ in range(20_000)]
    near = [("b", n[:5] + "zz" + n[6:]) for _, n in names[:50]]
    pairs = close_pairs(spark.createDataFrame(names + near, "block string, name string"), 2)
    got = pairs.collect()
    assert {(x["name_a"], x["name_b"]) for x in got} >= {(a[1], b[1]) for a, b in zip(names, near)}
    assert "NestedLoop" not in pairs._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in pairs._jdf.queryExecution().executedPlan().toString()
