"""Pages are fetched only where a filter may find something, and a stream of pages goes on where it broke."""

import json

import pytest

from acreflow.sources.paged import read_range, stream_pages


def make(folder, pages):
    for i in pages:
        (folder / f"page-{i}.json").write_text(json.dumps([{"id": 10 * i + j, "page": i} for j in range(10)]))
    (folder / "bounds.json").write_text(json.dumps([[10 * i, 10 * i + 9] for i in pages]))


def test_a_range_chooses_pages(spark, tmp_path):
    make(tmp_path, range(20))
    (tmp_path / "page-19.json").write_text("broken")  # fetching it fails
    for low, high, ids, fetched in ((35, 51, range(35, 52), 3), (77, 77, [77], 1), (None, 0, [0], 1), (180, 189, range(180, 190), 1), (500, None, [], 1)):
        got = read_range(spark, "id long, page long", str(tmp_path), 20, "id", low, high)
        assert sorted(r["id"] for r in got.collect()) == list(ids)
        assert got.rdd.getNumPartitions() == fetched, (low, high)
    a, b = (read_range(spark, "id long, page long", str(tmp_path), 20, "id", x, x + 4) for x in (10, 13))
    assert sorted(r["id"] for r in a.join(b.select("id"), "id").collect()) == [13, 14]
    with pytest.raises(Exception):
        read_range(spark, "id long", str(tmp_path), 20, "id", 190, None).collect()


def test_a_stream_goes_on_without_a_lost_or_doubled_row(spark, tmp_path):
    pages, out, at = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "at")
    pages.mkdir()

    def run():
        q = stream_pages(spark, "id long, page long", str(pages), at_once=4).writeStream.format("parquet").option("path", out).option("checkpointLocation", at).trigger(availableNow=True).start()
        try:
            q.awaitTermination(60)
        finally:
            q.stop()

    make(pages, range(5))
    run()
    (pages / "page-4.json").write_text("broken")
    with pytest.raises(Exception):
        run()
    make(pages, range(5))
    run()
    make(pages, range(8))
    run()
    run()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(80))
