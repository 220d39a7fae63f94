"""Content identifiers of files of any size.

A file is cut into chunks; each is a raw block with a digest.  More than one are tied together by link nodes (a list of children
with their sizes, in protobuf), level by level and ``fan`` at a time, until one node is left: the root, which names the file.
Every node's own digest covers its children's, so any block can be checked alone.

One task streams a file, chunk by chunk; link nodes are grouped and hashed by Spark, a level at a time.
"""

from __future__ import annotations

import hashlib
import io
import re
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreflow.functions.content_id import PREFIX, identifier
from acreflow.plans.storage import stored

#: Bytes of a chunk, and children of a link node, as nodes cut files unless they are told otherwise.
CHUNK_BYTES, FAN = 256 << 10, 174
#: Identifiers of version 1 with SHA-256 of 32 bytes, of raw blocks and of link nodes; the file type of a node's data.
RAW, LINKS = PREFIX, bytes([0x01, 0x70, 0x12, 0x20])
FILE_TYPE = 2
#: Stores that a task can open for streaming; of others rows are read whole by Spark's own reader.
STREAMED = ("file", "hdfs", "s3", "s3a", "gs")


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def field(number: int, body: bytes | int) -> bytes:
    """A protobuf field: a number, or bytes with their length."""
    return varint(number << 3) + varint(body) if isinstance(body, int) else varint(number << 3 | 2) + varint(len(body)) + body


def link_node(children: list[tuple[bytes, int, int]]) -> bytes:
    """A node that ties (identifier, file bytes, bytes of all blocks) together in their order."""
    links = b"".join(field(2, field(1, cid) + field(2, b"") + field(3, total)) for cid, _, total in children)
    data = field(1, FILE_TYPE) + field(3, sum(size for _, size, _ in children)) + b"".join(field(4, size) for _, size, _ in children)
    return links + field(1, data)


def opened(path: str) -> BinaryIO:
    """A file for streaming."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return open(re.sub("^file:/*", "/", path), "rb")
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    return store.open_input_stream(at)


_BLOCK = "path string, i long, digest binary, size long"


def _chunks(chunk: int):
    """The chunks of each file with their digests; as chunk -1 the digest of the whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = batch.column("content") if "content" in batch.schema.names else None
            for k, path in enumerate(batch.column("path").to_pylist()):
                whole, out, i, total = hashlib.sha256(), [], 0, 0
                with io.BytesIO(content[k].as_py()) if content is not None else opened(path) as f:
                    while (data := f.read(chunk)) or not i:
                        while len(data) < chunk and (more := f.read(chunk - len(data))):
                            data += more
                        whole.update(data)
                        out.append((path, i, hashlib.sha256(data).digest(), len(data)))
                        i, total = i + 1, total + len(data)
                        if len(out) == 4096:
                            yield _rows(out)
                            out = []
                yield _rows([*out, (path, -1, whole.digest(), total)])

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.binary(), pa.int64()))], ["path", "i", "digest", "size"])


_NODE = "path string, i long, n long, digest binary, size long, total long, n_links long"


def _tied(prefix: bytes):
    """Link nodes of children that come as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                own = link_node([(prefix + c["digest"], c["size"], c["total"]) for c in r["children"]])
                rows.append({"path": r["path"], "i": r["i"], "n": r["n"], "digest": hashlib.sha256(own).digest(), "size": sum(c["size"] for c in r["children"]), "total": len(own) + sum(c["total"] for c in r["children"]), "n_links": len(r["children"])})
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = [f.split()[0] for f in _NODE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], t) for c, t in zip(names, kinds, strict=True)], names)

    return run


def blocks(spark: SparkSession, folder: str, chunk: int = CHUNK_BYTES, fan: int = FAN, pattern: str = "*") -> tuple[DataFrame, DataFrame]:
    """(nodes, files) of all files below ``folder`` whose name fits ``pattern``.

    nodes: path, level (0: chunks), i (place in the level), n_links, digest (binary), size (file bytes below it), total (bytes
    of all its blocks), cid, root (whether it names the file).  files: path, n_bytes, sha256 (hexadecimal), cid,
    n_blocks.  Spark lists no empty files, so they are left out.  A task holds one chunk, or ``fan`` links; where a store cannot be streamed
    (not one of ``STREAMED``) files are read as rows, at most 2 GB each.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    streamed = folder.partition(":")[0] in STREAMED if ":" in folder else True
    found = stored(listed.select("path", *([] if streamed else ["content"])).mapInArrow(_chunks(chunk), _BLOCK), "chunks")
    wholes = found.filter("i < 0").select("path", F.col("size").alias("n_bytes"), F.lower(F.hex("digest")).alias("sha256"))
    counts = found.filter("i >= 0").groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    level = found.filter("i >= 0").join(counts, "path").select("path", "i", "n", "digest", "size", F.col("size").alias("total"), F.lit(0).cast("long").alias("n_links"))
    most, depth, out = counts.agg(F.max("n")).first()[0] or 0, 0, None
    while True:
        cid = F.concat(F.lit(RAW if not depth else LINKS), F.col("digest"))
        own = level.select("path", F.lit(depth).alias("level"), "i", "n_links", "digest", "size", "total", cid.alias("id"), (F.col("n") == 1).alias("root"))
        out = own if out is None else out.unionByName(own)
        if most <= 1:
            break
        inner = level.filter("n > 1").groupBy("path", F.floor(F.col("i") / fan).alias("at")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "digest", "size", "total"))).alias("children"))
        tied = inner.select("path", F.col("at").cast("long").alias("i"), F.ceil(F.col("n") / fan).cast("long").alias("n"), "children").mapInArrow(_tied(RAW if not depth else LINKS), _NODE)
        level, most, depth = stored(tied, f"level{depth + 1}"), -(-most // fan), depth + 1
    nodes = out.mapInArrow(_named, "path string, level int, i long, n_links long, digest binary, size long, total long, cid string, root boolean")
    roots = nodes.filter("root").select("path", "cid")
    sums = out.groupBy("path").agg(F.count(F.lit(1)).alias("n_blocks"))
    return nodes, wholes.join(roots, "path").join(sums, "path")


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identifiers as text; one for each block, so the hop into Python is small beside hashing it."""
    for batch in batches:
        cids = pa.array([identifier(x[: len(RAW)], x[len(RAW) :]) for x in batch.column("id").to_pylist()], pa.string())
        names = [n if n != "id" else "cid" for n in batch.schema.names]
        yield pa.RecordBatch.from_arrays([cids if n == "cid" else batch.column(k) for k, n in enumerate(names)], names)
