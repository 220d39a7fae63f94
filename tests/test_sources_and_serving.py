import datetime as dt
import io
import json
import sys
import threading
import urllib.request
from decimal import Decimal

import pytest
from dataclasses import replace
from pyspark.sql import functions as F

from acreflow.functions.content_id import cid_of_digest
from acreflow.functions.columns import normal_name
from acreflow.operators import links
from acreflow.serving import agent, page, rpc
from acreflow.serving.reasons import explained
from acreflow.serving.tools import TOOLS, Tables, catalogue, register_sql_functions, run_tool
from acreflow.sources import artifacts, load, run, sinks
from acreflow.sources.paged import drain, read_pages
from acreflow.streaming.pickup import pick_up

D = dt.date


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(
        property=spark.createDataFrame([(1, Decimal("50"), 1, "M-1", 41.0, -90.0, "61201", "A", "IL"), (2, Decimal("40"), 2, "R-1", 41.5, -90.0, "61201", "A", "IL"), (3, None, None, None, None, None, None, None, None)], "property_id long, acreage decimal(12,4), owner_id long, zoning string, lat double, lon double, situs_zip string, situs_city string, situs_state string"),
        transfer=spark.createDataFrame([(1, 1, D(2000, 1, 1)), (2, 2, D(2020, 1, 1))], "transfer_id long, property_id long, transfer_date date"),
        permit=spark.createDataFrame([(1, "Roofing", D(2000, 1, 1)), (2, "WAREHOUSE", D(2020, 1, 1))], "property_id long, permit_type string, issued_date date"),
        poi=spark.createDataFrame([(1, "power", 41.001, -90.0), (2, "transit", 41.5, -90.0)], "poi_id long, kind string, lat double, lon double"),
        owner=spark.createDataFrame([(1, "1", "B", "IA"), (2, "61201", "A", "IL")], "owner_id long, mail_zip string, mail_city string, mail_state string"),
    )


def ids(df):
    return sorted(r["property_id"] for r in df.select("property_id").collect())


def test_csv_load_sets_malformed_rows_aside(spark, tmp_path):
    (tmp_path / "p.csv").write_text("property_id,acreage,year_built,county\n1,10.5,1990,Rock\nx,1,1,Rock\n3,ten,2000,Rock\n4,,,Rock\n")
    good, bad = load.load(spark, "property", str(tmp_path / "p.csv"), "assessor", "r1", fmt="csv")
    assert sorted((r["property_id"], r["acreage"], r["prov"]["source_id"], r["prov"]["source_record_id"]) for r in good.collect()) == [(1, Decimal("10.5000"), "assessor", "1"), (4, None, "assessor", "4")]
    assert sorted(r["reasons"] for r in bad.collect()) == [["acreage: not a decimal(12,4)"], ["property_id: not a long", "property_id: missing"]]
    assert load.assert_county(good, "rock").count() == 2
    with pytest.raises(ValueError):
        load.assert_county(good.withColumn("county", F.lit(None).cast("string")), "Rock")


def test_dates_in_two_forms(spark):
    df = spark.createDataFrame([("2020-01-02",), ("01/02/2020",), ("soon",), (None,)], "d string")
    assert [r[0] for r in df.select(load.try_as(F.col("d"), "date")).collect()] == [D(2020, 1, 2), D(2020, 1, 2), None, None]


def test_links_locations_and_pois(spark, tmp_path):
    links = load.link_only(spark, "gis", "r", ["http://a.example/z"]).collect()
    assert links[0]["link_only"] is True and links[0]["source_url"] == "http://a.example/z" and links[0]["zoning_code"] is None
    p = spark.createDataFrame([(1, None, None), (2, 5.0, 6.0)], "property_id long, lat double, lon double")
    spots = spark.createDataFrame([(1, 1.0, 2.0), (1, 1.0, 2.0)], "property_id long, lat double, lon double")
    assert sorted(tuple(r) for r in load.with_location(p, spots).select("property_id", "lat", "lon").collect()) == [(1, 1.0, 2.0), (2, 5.0, 6.0)]
    (tmp_path / "poi.json").write_text('{"poi_id": 1, "kind": "Power", "lat": 1, "lon": 2}\n{"poi_id": 2, "kind": "transit", "lat": 1, "lon": 2}\n{"poi_id": 3, "kind": "power"}\n')
    good, bad = load.load_poi(spark, "power", str(tmp_path / "poi.json"), "osm", "r", "json")
    assert [r["poi_id"] for r in good.collect()] == [1] and bad.count() == 1


def test_paged_source(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"page-{i}.json").write_text(json.dumps([{"id": 10 * i + j, "name": f"n{j}"} for j in range(2)] + [{"id": 10 * i + 9}]))
    df = read_pages(spark, "id long, name string", str(tmp_path), 3)
    assert df.rdd.getNumPartitions() == 3
    assert sorted((r["id"], r["name"]) for r in df.collect()) == sorted((10 * i + j, f"n{j}" if j < 2 else None) for i in range(3) for j in (0, 1, 9))


def test_run_resumes_after_a_failure(spark, tmp_path):
    calls = []

    def source(name, fail):
        def read(s, run_id):
            calls.append(name)
            if fail and calls.count(name) == 1:
                raise OSError("site is down")
            good = s.createDataFrame([(1,)], "contractor_id long")
            return good, s.createDataFrame([], "raw string, reasons array<string>")

        return run.Source(name, "contractor", read, "pages of 100")

    both = [source("a", False), source("b", True)]
    rid = run.run(spark, both, str(tmp_path))
    assert run.run(spark, both, str(tmp_path), rid) == rid and calls == ["a", "b", "b"]
    log = sorted((r["source_id"], r["status"], r["n_rows"]) for r in run.read_log(spark, str(tmp_path)).collect())
    assert log == [("a", "done", 1), ("b", "done", 1), ("b", "failed", 0)]


def test_published_tables_read_back_and_rehash(spark, tables, tmp_path):
    import hashlib

    path = sinks.publish(tables.property, str(tmp_path), "property", "property_id")
    rows = sinks.eligible(sinks.manifest(spark, path, "property", "r"), ["property"]).collect()
    assert rows
    for r in rows:
        digest = hashlib.sha256(open(r["path"].removeprefix("file:"), "rb").read()).hexdigest()
        assert r["sha256"] == digest and r["cid"] == cid_of_digest(digest) and r["single_block"]
    duckdb = pytest.importorskip("duckdb")
    assert duckdb.sql(f"select count(*), sum(acreage) from '{path}/*.parquet'").fetchall() == [(3, Decimal("90.0000"))]


def test_pick_up_takes_each_file_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    spark.range(3).write.parquet(src)
    assert pick_up(spark, "id long", src, out, mark) == 3
    assert pick_up(spark, "id long", src, out, mark) == 0
    spark.range(3, 5).write.mode("append").parquet(src)
    assert pick_up(spark, "id long", src, out, mark) == 2 and spark.read.parquet(out).count() == 5


def test_tools(spark, tables):
    assert ids(run_tool("stable_parcels", tables, years=10)) == [1]
    assert ids(run_tool("stable_parcels", tables, years=1)) == [1, 2]
    assert ids(run_tool("no_transfer_since", tables)) == [1, 3]
    assert ids(run_tool("old_roofs", tables)) == [1]
    assert ids(run_tool("near_places", tables, kind="power")) == [1]
    assert ids(run_tool("industrial_signals", tables)) == [1, 2]
    assert ids(run_tool("owner_areas", tables)) == [1]
    ranked = run_tool("candidates", tables, k=2).collect()
    assert [r["property_id"] for r in sorted(ranked, key=lambda r: r["rank"])] == [1, 2] and ranked[0]["missing"] == []
    with pytest.raises(ValueError):
        run_tool("stable_parcels", tables, acres=1)
    signals = {r["property_id"]: r for r in run_tool("power_or_industrial", tables).collect()}
    assert {k: r["basis"] for k, r in signals.items()} == {1: ["power within 111 m", "zoning: M-1"], 2: ["permits: 1"]}
    both = run_tool("stable_with_signals", tables).collect()
    assert [(r["property_id"], r["basis"], len(r["ownership_history"])) for r in both] == [(1, ["power within 111 m", "zoning: M-1"], 1)] and '"property_id":1' in both[0]["evidence"]
    assert ids(run_tool("no_transfer_since", tables, years=1)) == [1, 2, 3] and ids(run_tool("water_views", tables)) == []
    zoned = replace(tables, zoning=tables.property.sparkSession.createDataFrame([(2, "I-1", "x", D(2020, 1, 1), False), (1, "R-9", "x", D(2020, 1, 1), False), (1, "I-1", "x", None, True)], "property_id long, zoning_code string, land_use_code string, effective_date date, link_only boolean"))
    assert {r["property_id"]: r["basis"] for r in run_tool("power_or_industrial", zoned).collect()} == {1: ["power within 111 m"], 2: ["permits: 1", "zoning: I-1"]}
    with pytest.raises(ValueError):
        run_tool("totals_by_source", tables)
    with pytest.raises(ValueError):
        run_tool("run_summary", tables)


def test_agent_and_page_give_the_tools_rows(tables):
    prompt = "Which parcels of at least 45 acres have stable ownership (no recorded transfer in the last 10+ years)?"
    found = agent.match(prompt)
    assert found.tool == "no_transfer_since" and found.arguments == {"years": 10, "inclusive": True, "min_acres": 45.0}
    got = agent.answer(prompt, tables)
    assert [r["property_id"] for r in got["rows"]] == ids(run_tool(found.tool, tables, **found.arguments)) == [1]
    assert "45.0 acres" in got["reasoning"] and got["assumptions"]
    assert [r["explanation"] for r in got["rows"]] == ["50.0000 acres; last recorded transfer on 2000-01-01; 1 recorded transfers"]
    said = {r["property_id"]: r["explanation"] for r in explained(run_tool("power_or_industrial", tables)).collect()}
    assert said == {1: "50.0000 acres; power within 111 m, zoning: M-1", 2: "40.0000 acres; permits: 1"}
    odd = tables.property.select("property_id", F.lit("x").alias("basis"), F.lit(None).cast("int").alias("acreage"))
    assert {r["explanation"] for r in explained(odd).collect()} == {""} == {r["explanation"] for r in explained(odd.select("property_id")).collect()}
    assert agent.answer("what is the weather", tables)["catalogue"] == catalogue()
    status, text = page.render("/stable_parcels?min_acres=45&years=10", tables)
    assert status == 200 and "<td>1</td>" in text and "<td>2</td>" not in text
    assert page.render("/nothing", tables)[0] == 404 and page.render("/stable_parcels?min_acres=<b>", tables)[0] == 400


@pytest.mark.parametrize(("prompt", "tool"), [
    ("properties with roofs older than 15 years", "old_roofs"), ("within walking distance of Starbucks", "near_places"), ("a view of water", "water_views"),
    ("Which properties appear to be strong candidates for further data-center review?", "candidates"), ("properties with out-of-area owners", "owner_areas"),
    ("Show properties near candidate power infrastructure or with relevant industrial/zoning signals where data is available.", "power_or_industrial"), ("Show the total uploaded records by source.", "totals_by_source"), ("I am opening the pipeline run summary", "run_summary"),
    ("Which larger parcels in Rock Island County have stable ownership (no recorded transfer in the last 10+ years) and any available signals related to power or industrial suitability?", "stable_with_signals"), ("parcels with no recorded transfer in 10 years", "no_transfer_since"),
    ("not exchanged ownership in more than 10 years", "stable_parcels"), ("industrial zoning history", "industrial_signals"), ("assemblages above 100 acres", "assemblages"),
])
def test_prompts(prompt, tool):
    assert agent.match(prompt).tool == tool


def test_totals_by_source_over_all_tables(spark):
    prov = "struct<source_id: string, collected_at: timestamp_ntz>"
    made = lambda n, s: spark.createDataFrame([(i, (s, dt.datetime(2024, 1, 1 + i))) for i in range(n)], f"id long, prov {prov}")
    got = run_tool("totals_by_source", Tables(property=made(2, "a"), business=made(3, "b"), permit=made(1, "a"))).collect()
    assert sorted((r["dataset"], r["source_id"], r["n_rows"]) for r in got) == [("business", "b", 3), ("permit", "a", 1), ("property", "a", 2)]


def test_a_source_of_unknown_length_is_drained(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"page-{i}.json").write_text(json.dumps([{"id": 10 * i + j} for j in range(3)]))
    for _ in range(2):
        got = drain(spark, "id long", str(tmp_path), str(tmp_path / "kept"), at_once=2)
        assert sorted(r["id"] for r in got.collect()) == [10 * i + j for i in range(5) for j in range(3)]


def test_entities_link_owners_and_businesses(spark):
    owners = spark.createDataFrame([(1, "Acme Corp."), (2, "ACME, LLC"), (3, None), (4, "Other")], "owner_id long, name string")
    firms = spark.createDataFrame([(7, "acme inc"), (8, None), (9, "Nobody")], "business_id long, name string")
    found = links.entity_map(owners, "owner", "owner_id", normal_name(F.col("name"))).unionByName(links.entity_map(firms, "business", "business_id", normal_name(F.col("name"))))
    got = links.owner_businesses(owners, firms, found).collect()
    assert sorted((r["owner_id"], r["business_id"]) for r in got if r["business_id"]) == [(1, 7), (2, 7)] and len(got) == 4
    assert found.columns == ["entity_kind", "record_key", "canonical_id", "match_rule", "score"]


def test_rpc_round_trip(tables):
    messages = [
        {"jsonrpc": "2.0", "id": 1, "method": "initialize"}, {"jsonrpc": "2.0", "method": "notifications/initialized"}, {"jsonrpc": "2.0", "id": 2, "method": "tools/list"},
        {"jsonrpc": "2.0", "id": 3, "method": "tools/call", "params": {"name": "stable_parcels", "arguments": {"years": 10}}},
        {"jsonrpc": "2.0", "id": 4, "method": "tools/call", "params": {"name": "ask", "arguments": {"prompt": "roofs older than 15 years"}}},
        {"jsonrpc": "2.0", "id": 5, "method": "tools/call", "params": {"name": "none"}}, {"jsonrpc": "2.0", "id": 6, "method": "other"},
    ]
    out = io.StringIO()
    rpc.serve(tables, io.StringIO("".join(json.dumps(m) + "\n" for m in messages) + "{\n"), out)
    replies = [json.loads(x) for x in out.getvalue().splitlines()]
    assert [r["id"] for r in replies] == [1, 2, 3, 4, 5, 6, None]
    assert {t["name"] for t in replies[1]["result"]["tools"]} == {*TOOLS, "ask"}
    body = json.loads(replies[2]["result"]["content"][0]["text"])
    assert [r["property_id"] for r in body["rows"]] == [1] and body["schema"]["type"] == "struct"
    assert json.loads(replies[3]["result"]["content"][0]["text"])["tool"] == "old_roofs"
    assert replies[4]["result"]["isError"] and replies[5]["error"]["code"] == -32601 and replies[6]["error"]["code"] == -32700


def test_server(tables):
    s = page.server(tables)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    try:
        assert b"stable_parcels" in urllib.request.urlopen(f"http://127.0.0.1:{s.server_address[1]}/", timeout=20).read()
    finally:
        s.shutdown()


def test_sql_table_function(spark, tables):
    tables.property.createOrReplaceTempView("property")
    tables.transfer.createOrReplaceTempView("transfer")
    register_sql_functions(spark)
    assert [r[0] for r in spark.sql("SELECT property_id FROM stable_parcels(:acres, :before)", args={"acres": 45.0, "before": D(2015, 1, 1)}).collect()] == [1]


def test_entry_imports_without_the_text_package(tmp_path):
    import shutil
    import subprocess
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for name in ("acreflow", "__spark_entry__.py"):
        (shutil.copytree if (root / name).is_dir() else shutil.copy)(root / name, tmp_path / name)
    shutil.rmtree(tmp_path / "acreflow" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'stable_large_parcels' in q and not [n for n in q if n.startswith('op')], q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
