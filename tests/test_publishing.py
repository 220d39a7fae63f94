"""Snapshots are published whole or not at all; records lead back to their rows."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from acreflow.plans import commits, storage
from acreflow.sources import load, sinks


def test_a_broken_run_leaves_the_old_snapshot(spark, tmp_path, monkeypatch):
    folder, df = str(tmp_path), spark.range(1000).withColumn("v", F.col("id") * 2)
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, folder, "t")
    sinks.publish_snapshot(df.filter("id < 10"), folder, "t", "id")
    reader = sinks.published(spark, folder, "t")
    broken = df.repartition(8).withColumn("v", F.when(F.col("id") == 777, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        sinks.publish_snapshot(broken, folder, "t", "id")
    assert sinks.published(spark, folder, "t").count() == 10
    with monkeypatch.context() as m:  # the driver dies when all files are there but the pointer is not swapped
        m.setattr(commits, "swap", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.publish_snapshot(df, folder, "t", "id")
    assert sinks.published(spark, folder, "t").count() == 10
    sinks.publish_snapshot(df, folder, "t", "id", rows_per_file=100)
    assert reader.count() == 10 and sinks.published(spark, folder, "t").count() == 1000
    at = json.loads((tmp_path / "t" / sinks.POINTER).read_text())["snapshot"]
    assert duckdb.sql(f"select count(*), sum(v) from read_parquet('{folder}/t/{at}/*.parquet')").fetchall() == [(1000, 999000)]
    assert len(commits.folders(spark, f"{folder}/t")) == 3 and sinks.retire(spark, folder, "t") == 2
    assert sinks.published(spark, folder, "t").count() == 1000 and sinks.retire(spark, folder, "t") == 0
    sinks.publish_snapshot(df.filter("false"), folder, "t", "id")
    assert sinks.published(spark, folder, "t").columns == ["id", "v"] and sinks.published(spark, folder, "t").isEmpty()


def test_records_lead_back_to_file_and_row(spark, tmp_path):
    raw = spark.createDataFrame([(i, f"n{i}", "z") for i in range(40)], "contractor_id long, name string, raw string")
    raw.repartition(3).write.parquet(f"{tmp_path}/in")
    good, _ = load.load(spark, "contractor", f"{tmp_path}/in", "s", "r")
    good.write.parquet(f"{tmp_path}/out")
    found = load.raw_rows(spark.read.parquet(f"{tmp_path}/out"), load.read_raw(spark, f"{tmp_path}/in"), "contractor_id").collect()
    assert sorted((r["contractor_id"], r["raw"]["name"], r["raw"]["raw"]) for r in found) == [(i, f"n{i}", "z") for i in range(40)]
    assert len({r["source_file"] for r in found}) == 3
    raw.write.csv(f"{tmp_path}/csv", header=True)
    good, _ = load.load(spark, "contractor", f"{tmp_path}/csv", "s", "r", fmt="csv")
    assert {(r["prov"]["source_file"] is None, r["prov"]["source_row"]) for r in good.collect()} == {(False, None)}
    made = load.with_prov(raw, "s", "r", F.col("contractor_id")).select("prov.source_file", "prov.source_row").distinct().collect()
    assert [tuple(r) for r in made] == [(None, None)]


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": self["dir"]}.get(key, default)

    class Session:
        def __init__(self, master, folder):
            self.conf, self.sparkContext = Conf(dir=folder), type("C", (), {"master": master})()

    assert storage.shared_dir(Session("local[4]", "file:/x/")) == "file:/x" and storage.shared_dir(Session("yarn", "hdfs://n/x")) == "hdfs://n/x"
    for master, folder in (("yarn", "file:///x"), ("spark://h:7077", None)):
        with pytest.raises(RuntimeError):
            storage.shared_dir(Session(master, folder))
