"""A source that is read page by page, as a Spark data source: pages are partitions, read by the executors.

Where the source says which range of a key each page holds, a range that is asked for chooses the pages, and the others are
not fetched.  (The range is an option of the reader.  Spark hands a filter to the source object that all plans of one
DataFrame share, so two plans of it could get each other's pages.)  As a stream its offsets are page numbers, so what a broken query has not committed is read again.
"""

from __future__ import annotations

import importlib
import json
import os
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


class Page(InputPartition):
    def __init__(self, number: int) -> None:
        self.number = number


def pages_of_json(folder: str, number: int) -> list[dict]:
    """The rows of one page kept as ``page-<n>.json`` (an array of objects); none beyond the last.  The stand-in for a remote fetch."""
    path = f"{folder}/page-{number}.json"
    if not os.path.exists(path):
        return []
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def bounds_of_json(folder: str) -> list[tuple]:
    """(least, greatest) key of each page, kept as ``bounds.json``."""
    with open(f"{folder}/bounds.json", encoding="utf-8") as f:
        return [tuple(x) for x in json.load(f)]


def _named(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class _Pages:
    """Fetching of pages, for both kinds of reader."""

    def __init__(self, schema, options: dict) -> None:
        self.names, self.options = schema.fieldNames(), options

    def read(self, partition: Page | None) -> Iterator[tuple]:
        if partition is None:  # no page is left
            return
        fetch = _named(self.options.get("fetch", "acreflow.sources.paged:pages_of_json"))
        for row in fetch(self.options["location"], partition.number):
            yield tuple(row.get(n) for n in self.names)


class PagedReader(_Pages, DataSourceReader):
    def partitions(self) -> list[Page]:
        pages = range(int(self.options.get("first", 0)), int(self.options["pages"]))
        if name := self.options.get("bounds"):
            low, high = json.loads(self.options.get("between", "[null, null]"))
            held = _named(name)(self.options["location"])
            fits = lambda a, b: (low is None or b >= low) and (high is None or a <= high)
            pages = [i for i in pages if i >= len(held) or fits(*held[i])]
        return [Page(i) for i in pages]


class PagedStreamReader(_Pages, DataSourceStreamReader):
    """Pages as they appear; ``at_once`` pages a batch at most."""

    def initialOffset(self) -> dict:  # noqa: N802
        self._last = int(self.options.get("first", 0))
        return {"page": self._last}

    def latestOffset(self) -> dict:  # noqa: N802
        fetch = _named(self.options.get("fetch", "acreflow.sources.paged:pages_of_json"))
        first = last = getattr(self, "_last", int(self.options.get("first", 0)))
        while last - first < int(self.options.get("at_once", 64)) and any(True for _ in fetch(self.options["location"], last)):
            last += 1
        return {"page": last}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        self._last = max(end["page"], getattr(self, "_last", 0))
        return [Page(i) for i in range(start["page"], end["page"])]

    def commit(self, end: dict) -> None:
        self._last = max(end["page"], getattr(self, "_last", 0))


class PagedSource(DataSource):
    """Options: location; fetch (``module:function`` of (location, page) -> list of dicts); first; pages, for a batch;
    bounds (``module:function`` of location -> (least, greatest) key of each page) and between (a JSON array of two keys), to choose
    pages by; at_once, for a stream."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        raise ValueError("give a schema")

    def reader(self, schema) -> PagedReader:
        return PagedReader(schema, self.options)

    def streamReader(self, schema) -> PagedStreamReader:  # noqa: N802
        return PagedStreamReader(schema, self.options)


def _options(**options: str | int | None) -> dict[str, str]:
    return {k: str(v) for k, v in options.items() if v is not None}


def read_pages(spark: SparkSession, schema: str, location: str, pages: int, first: int = 0, fetch: str | None = None) -> DataFrame:
    """The rows of pages ``first`` to ``pages``."""
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged").schema(schema).options(**_options(location=location, pages=pages, first=first, fetch=fetch)).load()


def read_range(spark: SparkSession, schema: str, location: str, pages: int, key: str, low, high, bounds: str = "acreflow.sources.paged:bounds_of_json", fetch: str | None = None) -> DataFrame:
    """The rows whose ``key`` lies between ``low`` and ``high``, both included, None for no end; only pages that may hold some are
    fetched.  Pages without bounds are."""
    spark.dataSource.register(PagedSource)
    options = _options(location=location, pages=pages, fetch=fetch, bounds=bounds, between=json.dumps([low, high]))
    out = spark.read.format("paged").schema(schema).options(**options).load()
    out = out if low is None else out.filter(F.col(key) >= F.lit(low))
    return out if high is None else out.filter(F.col(key) <= F.lit(high))


def stream_pages(spark: SparkSession, schema: str, location: str, first: int = 0, fetch: str | None = None, at_once: int | None = None) -> DataFrame:
    """A stream of pages from ``first`` on, up to the first empty one for now."""
    spark.dataSource.register(PagedSource)
    return spark.readStream.format("paged").schema(schema).options(**_options(location=location, first=first, fetch=fetch, at_once=at_once)).load()


def drain(spark: SparkSession, schema: str, location: str, folder: str, at_once: int = 64, fetch: str | None = None) -> DataFrame:
    """All rows of a source of unknown length, kept below ``folder``: ``at_once`` pages at a time, until the last of them
    is empty.  Pages before the end are not empty.  Called again after a break, it reads on behind what is whole."""
    first = 0
    while True:
        path = f"{folder}/from-{first}"
        files = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files):
            read_pages(spark, schema, location, first + at_once, first, fetch).write.mode("overwrite").parquet(path)
        if read_pages(spark, schema, location, first + at_once, first + at_once - 1, fetch).isEmpty():
            return spark.read.schema(schema).parquet(f"{folder}/from-*")
        first += at_once
