"""Small files that are replaced as a whole: readers see the old text or the new one, never a part."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def swap(spark: SparkSession, path: str, text: str) -> None:
    """Puts ``text`` where readers look, by renaming a finished file over the old one (atomic where the store's rename is)."""
    fresh, fs = _path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(fresh)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    target, _ = _path(spark, path)
    jvm = spark._jvm
    how = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    how[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(fresh), fs.makeQualified(target), how)


def current(spark: SparkSession, path: str) -> str | None:
    """The text there, or None if nothing was put there yet."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path."""
    target, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()) if fs.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)
