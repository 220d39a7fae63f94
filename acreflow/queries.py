"""The registered queries on the bench fixtures, each an operator of this library on a stand-in, with its SQL for DuckDB."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreflow.functions.columns import block_key, digest, url_part
from acreflow.operators import assemblages as asm
from acreflow.operators import labels, links, matching, ownership, permits, proximity, ranking, reconcile, runlog, score, selection
from acreflow.plans import standins as on
from acreflow.plans.storage import shared_folder
from acreflow.sources import artifacts, load, payloads, run, sinks

AS_OF = dt.date(2001, 8, 2)
SINCE = dt.date(2000, 8, 2)
WHEN = dt.date(1998, 1, 1)
YEARS, MIN_ACRES, ROOF_YEARS = 1, 40.0, 1
MAX_LAT = 42.0

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Stand-ins of the fixtures as SQL, like those of ``standins``.
_PROPERTY = """property AS (SELECT c_custkey AS property_id, c_name AS parcel_no, CASE WHEN c_acctbal > 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,4)) END AS acreage,
  c_mktsegment AS zoning, c_nationkey AS owner_id, 41.3e0 + (c_custkey * 7919 % 1000) * 0.0004e0 AS lat, -90.9e0 + (c_custkey * 104729 % 1000) * 0.0008e0 AS lon FROM customer)"""
_TRANSFER = "transfer AS (SELECT o_orderkey AS transfer_id, o_custkey AS property_id, CAST(o_orderdate AS DATE) AS transfer_date, CAST(o_totalprice AS DECIMAL(14,2)) AS price FROM orders)"
_PERMIT = "permit AS (SELECT o_custkey AS property_id, l_returnflag AS permit_type, CAST(l_shipdate AS DATE) AS issued_date, l_suppkey AS contractor_id, p_type AS description FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey)"
_POI = "poi AS (SELECT s_suppkey AS poi_id, 41.3e0 + (s_suppkey * 6101 % 1000) * 0.0004e0 AS lat, -90.9e0 + (s_suppkey * 3571 % 1000) * 0.0008e0 AS lon FROM supplier)"
_LOG = "log AS (SELECT user_id % 10 AS source, event_type AS stage, value AS seconds, ts AS seen_at, event_type = 'error' AS failed FROM events)"


def _metres(a: str, b: str) -> str:
    return f"2e0 * 6371008.8e0 * asin(sqrt(least(1e0, pow(sin((radians({b}.lat) - radians({a}.lat)) / 2e0), 2e0) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2e0), 2e0))))"


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@register(f"""WITH {_PROPERTY}, {_TRANSFER},
last AS (SELECT property_id, max(transfer_date) AS last_transfer, count(*) AS n_transfers, array_to_string(list(CAST(transfer_date AS VARCHAR) || '#' || transfer_id ORDER BY transfer_date, transfer_id), ' ') AS ownership_history FROM transfer GROUP BY property_id)
SELECT p.property_id, parcel_no, CAST(acreage AS DOUBLE) AS acres, last_transfer, n_transfers, ownership_history, 'customer' AS source_id, CAST(p.property_id AS VARCHAR) AS source_record_id, sha256(CAST(p.property_id AS VARCHAR)) AS content_sha256,
  to_json(struct_pack(property_id := p.property_id, n_transfers := n_transfers, last_transfer := CAST(last_transfer AS VARCHAR))) AS evidence
FROM property p JOIN last USING (property_id) WHERE last_transfer < DATE '2000-08-02' AND acreage >= 40""")
def stable_large_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-held parcels of a least size, with their ownership history, provenance and evidence."""
    moves = on.transfers(spark, sf_dir)
    parcels = on.properties(spark, sf_dir).filter(F.col("acreage") >= F.lit(MIN_ACRES))
    held = ownership.tenure_over(parcels, moves, AS_OF, YEARS)
    out = held.join(ownership.history(moves), "property_id", "left")
    story = F.array_join(F.transform("ownership_history", lambda t: F.concat(t["transfer_date"].cast("string"), F.lit("#"), t["transfer_id"].cast("string"))), " ")
    out = score.with_evidence(out, {"property_id": F.col("property_id"), "n_transfers": F.col("n_transfers"), "last_transfer": F.col("last_transfer").cast("string")})
    return out.select("property_id", "parcel_no", F.col("acreage").cast("double").alias("acres"), "last_transfer", "n_transfers", story.alias("ownership_history"), "prov.source_id", "prov.source_record_id", "prov.content_sha256", "evidence")


@register(f"WITH {_TRANSFER} SELECT property_id, max(transfer_date) AS last_transfer, count(*) AS n_transfers FROM transfer GROUP BY property_id HAVING max(transfer_date) < DATE '2000-08-02'")
def tenure_over_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.tenure_over(on.properties(spark, sf_dir), on.transfers(spark, sf_dir), AS_OF, YEARS).select("property_id", "last_transfer", "n_transfers")


@register(f"WITH {_PROPERTY}, {_TRANSFER} SELECT property_id, parcel_no FROM property p WHERE NOT EXISTS (SELECT 1 FROM transfer t WHERE t.property_id = p.property_id AND t.transfer_date >= DATE '2000-08-02')")
def no_transfer_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.no_transfer_since(on.properties(spark, sf_dir), on.transfers(spark, sf_dir), SINCE).select("property_id", "parcel_no")


@register(f"WITH {_TRANSFER} SELECT property_id, transfer_id, transfer_date, price FROM transfer WHERE transfer_date <= DATE '1998-01-01' QUALIFY row_number() OVER (PARTITION BY property_id ORDER BY transfer_date DESC, transfer_id DESC) = 1")
def owner_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.owner_as_of(on.transfers(spark, sf_dir), WHEN).select("property_id", "transfer_id", "transfer_date", "price")


@register(f"""WITH {_TRANSFER}, {_PERMIT}, t AS (SELECT property_id, transfer_date, max(transfer_id) AS transfer_id FROM transfer GROUP BY ALL)
SELECT p.property_id, p.issued_date, p.permit_type, p.contractor_id, t.transfer_id FROM permit p ASOF LEFT JOIN t ON p.property_id = t.property_id AND p.issued_date >= t.transfer_date""")
def asof_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = on.permits(spark, sf_dir).select("property_id", "issued_date", "permit_type", "contractor_id")
    return ownership.as_of_join(left, on.transfers(spark, sf_dir), "property_id", "issued_date", "transfer_date", "transfer_id")


@register(f"""WITH {_TRANSFER}, n AS (SELECT *, lead(transfer_date) OVER (PARTITION BY property_id ORDER BY transfer_date, transfer_id) AS next_date FROM transfer)
SELECT property_id, transfer_id, transfer_date, next_date, CAST(date_diff('day', transfer_date, coalesce(next_date, DATE '2001-08-02')) AS INTEGER) AS days_held FROM n""")
def holding_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.holding_periods(on.transfers(spark, sf_dir), AS_OF)


@register(f"""WITH {_TRANSFER}, n AS (SELECT *, coalesce(lead(transfer_date) OVER (PARTITION BY property_id ORDER BY transfer_date, transfer_id), DATE '2001-08-02') AS next_date FROM transfer)
SELECT property_id, count(*) AS n_transfers, max(transfer_date) AS last_transfer, CAST(date_diff('day', max(transfer_date), DATE '2001-08-02') AS INTEGER) AS tenure_days, CAST(sum(date_diff('day', transfer_date, next_date)) AS DOUBLE) / count(*) AS mean_days_held FROM n GROUP BY property_id""")
def ownership_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.ownership_stability(on.transfers(spark, sf_dir), AS_OF)


@register(f"WITH {_TRANSFER} SELECT property_id, transfer_id, transfer_date, price FROM transfer QUALIFY row_number() OVER (PARTITION BY property_id ORDER BY transfer_date DESC, transfer_id DESC) = 1")
def current_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.current_owner(on.transfers(spark, sf_dir)).select("property_id", "transfer_id", "transfer_date", "price")


@register("""WITH o AS (SELECT c_custkey, c.c_nationkey AS situs, s.s_nationkey AS mail FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey % 10)
SELECT c_custkey AS property_id, CASE WHEN a.n_nationkey IS NULL OR b.n_nationkey IS NULL THEN 'unknown' WHEN situs = mail THEN 'local' WHEN a.n_regionkey = b.n_regionkey THEN 'regional' ELSE 'out_of_area' END AS owner_area
FROM o LEFT JOIN nation a ON a.n_nationkey = situs LEFT JOIN nation b ON b.n_nationkey = mail""")
def out_of_area_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as parcel, the supplier with its last digit as owner; nation as zip and region as state."""
    nation = on.table(spark, sf_dir, "nation")
    end = lambda x: nation.select(F.col("n_nationkey").alias(f"{x}_key"), F.col("n_nationkey").cast("string").alias(f"{x}_zip"), F.col("n_regionkey").cast("string").alias(f"{x}_state"))
    parcels = on.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("property_id"), F.col("c_nationkey").alias("situs_key"), (F.col("c_custkey") % 10).alias("s_suppkey"))
    owners = on.table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("mail_key"))
    both = parcels.join(owners, "s_suppkey", "left").join(end("situs"), "situs_key", "left").join(end("mail"), "mail_key", "left")
    return ownership.owner_area(both, {"zip": "mail_zip", "state": "mail_state"}, {"zip": "situs_zip", "state": "situs_state"}).select("property_id", "owner_area")


@register(f"""WITH {_PROPERTY}, {_PERMIT}, r AS (SELECT property_id, max(issued_date) AS roof_date FROM permit WHERE permit_type = 'R' GROUP BY property_id)
SELECT p.property_id, roof_date, CASE WHEN roof_date IS NOT NULL THEN 'permit' END AS roof_source, roof_date < DATE '2000-08-02' AS old_roof FROM property p LEFT JOIN r USING (property_id)""")
def roof_age_tristate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permits.roof_age(on.properties(spark, sf_dir), on.permits(spark, sf_dir), AS_OF, ROOF_YEARS, F.col("permit_type") == "R").select("property_id", "roof_date", "roof_source", "old_roof")


_SIGNAL = "permit_type = 'R' AND description IN ('PROMO', 'LARGE')"
_INDUSTRIAL = f"""i AS (SELECT p.property_id, p.zoning, coalesce(n, 0) AS n_signals, last_signal, concat_ws('; ', CASE WHEN n >= 5 THEN 'permits: ' || n END, CASE WHEN upper(zoning) IN ('MACHINERY') THEN 'zoning: ' || zoning END) AS basis
  FROM property p LEFT JOIN (SELECT property_id, count(*) AS n, max(issued_date) AS last_signal FROM permit WHERE {_SIGNAL} GROUP BY property_id) s USING (property_id))"""


def _industrial(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_signal = (F.col("permit_type") == "R") & F.col("description").isin("PROMO", "LARGE")
    return permits.industrial_signal(on.properties(spark, sf_dir), on.permits(spark, sf_dir), is_signal, ("MACHINERY",), 5)


@register(f"WITH {_PROPERTY}, {_PERMIT}, {_INDUSTRIAL} SELECT property_id, n_signals, last_signal, basis FROM i WHERE basis <> ''")
def industrial_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _industrial(spark, sf_dir).filter("industrial").select("property_id", "n_signals", "last_signal", F.array_join("basis", "; ").alias("basis"))


@register(f"WITH {_PERMIT} SELECT property_id, permit_type, issued_date, contractor_id, s_name AS contractor_name FROM permit LEFT JOIN supplier ON s_suppkey = contractor_id")
def permit_contractors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permits.with_contractors(on.permits(spark, sf_dir), on.contractors(spark, sf_dir)).select("property_id", "permit_type", "issued_date", "contractor_id", "contractor_name")


@register(f"WITH {_PROPERTY}, {_POI} SELECT property_id, poi_id, CAST(floor({_metres('a', 'b')}) AS BIGINT) AS metres FROM property a, poi b WHERE {_metres('a', 'b')} <= 800e0")
def near_poi_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = proximity.within(on.properties(spark, sf_dir).select("property_id", "lat", "lon"), on.pois(spark, sf_dir), 800.0, MAX_LAT)
    return pairs.select("property_id", "poi_id", F.floor("distance_m").cast("long").alias("metres"))


@register(f"WITH {_PROPERTY}, {_POI} SELECT property_id, parcel_no FROM property a WHERE EXISTS (SELECT 1 FROM poi b WHERE {_metres('a', 'b')} <= 800e0)")
def near_poi_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proximity.near(on.properties(spark, sf_dir), on.pois(spark, sf_dir), "property_id", 800.0, MAX_LAT).select("property_id", "parcel_no")


@register(f"WITH {_PROPERTY}, {_POI}, d AS (SELECT property_id, poi_id, {_metres('a', 'b')} AS m FROM property a, poi b) SELECT property_id, CAST(floor(min(m)) AS BIGINT) AS metres FROM d GROUP BY property_id")
def nearest_poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proximity.nearest(on.properties(spark, sf_dir), on.pois(spark, sf_dir), "property_id", "poi_id", 3000.0, MAX_LAT).select("property_id", F.floor("distance_m").cast("long").alias("metres"))


@register(f"""WITH {_PROPERTY}, {_PERMIT}, {_POI}, {_INDUSTRIAL}, n AS (SELECT property_id, min({_metres('a', 'b')}) AS m FROM property a, poi b WHERE {_metres('a', 'b')} <= 800e0 GROUP BY property_id)
SELECT property_id, concat_ws('; ', CASE WHEN m IS NOT NULL THEN 'power within ' || CAST(floor(m) AS BIGINT) || ' m' END, CASE WHEN basis <> '' THEN basis END) AS basis FROM i LEFT JOIN n USING (property_id) WHERE m IS NOT NULL OR basis <> ''""")
def power_or_industrial(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_signal = (F.col("permit_type") == "R") & F.col("description").isin("PROMO", "LARGE")
    out = links.power_or_industrial(on.properties(spark, sf_dir), on.permits(spark, sf_dir), on.pois(spark, sf_dir), is_signal, ("MACHINERY",), 5, 800.0, MAX_LAT)
    return out.select("property_id", F.array_join("basis", "; ").alias("basis"))


@register(f"""WITH RECURSIVE {_PROPERTY}, e AS (SELECT a.property_id AS a, b.property_id AS b FROM property a JOIN property b ON a.owner_id = b.owner_id AND a.property_id <> b.property_id WHERE {_metres('a', 'b')} <= 3000e0),
r AS (SELECT property_id AS n, property_id AS root FROM property UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.n),
c AS (SELECT n AS property_id, min(root) AS assemblage_id FROM r GROUP BY n)
SELECT assemblage_id, count(*) AS n_parcels, CAST(sum(acreage) AS DOUBLE) AS acres, count(*) FILTER (WHERE acreage IS NULL) AS n_unknown, array_to_string(list(property_id ORDER BY property_id), ' ') AS members FROM c JOIN property USING (property_id)
GROUP BY assemblage_id HAVING count(*) >= 2 AND sum(acreage) >= 200""")
def assemblages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = asm.assemblages(on.properties(spark, sf_dir), 3000.0, 200.0, 2, MAX_LAT)
    return out.select("assemblage_id", "n_parcels", F.col("acreage").cast("double").alias("acres"), "n_unknown", F.array_join(F.transform("members", lambda m: m.cast("string")), " ").alias("members"))


@register("SELECT source, lang, count(*) AS n_rows, min(doc_id) AS first_collected, max(doc_id) AS last_collected FROM documents GROUP BY source, lang")
def totals_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.totals_by_source(on.table(spark, sf_dir, "documents"), "source", "lang", collected_at="doc_id")


@register(f"""WITH {_LOG} SELECT source, stage, count(*) AS n_stages, CAST(sum(seconds) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN failed THEN 1 ELSE 0 END) AS BIGINT) AS n_errors, min(seen_at) AS started_at, max(seen_at + INTERVAL 60 SECOND) AS ended_at, 60e0 AS p95_seconds,
  CASE WHEN bool_or(failed) THEN 'failed' ELSE '' END AS limitations FROM (SELECT source, stage, floor(seconds) AS seconds, seen_at, failed FROM log) GROUP BY source, stage""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a run log: each a stage of a minute with its value as rows."""
    log = on.load_log(spark, sf_dir).select(
        "source", "stage", F.floor("seconds").cast("long").alias("n_rows"), F.col("failed").cast("long").alias("n_errors"),
        F.col("at").alias("started_at"), (F.col("at") + F.expr("INTERVAL 60 SECOND")).alias("ended_at"), F.when(F.col("failed"), "failed").alias("limitation"),
    )
    return runlog.run_summary(log, "source", "stage").withColumn("limitations", F.array_join("limitations", "; "))


@register(f"WITH {_LOG} SELECT source, count(*) AS n_stages, quantile_disc(seconds, 0.95) AS p95_seconds, CAST(sum(CASE WHEN failed THEN 1 ELSE 0 END) AS BIGINT) AS n_failed FROM log GROUP BY source ORDER BY p95_seconds DESC, source LIMIT 5")
def slow_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.slow_sources(on.load_log(spark, sf_dir), "source", "seconds", "failed", 5)


@register(f"WITH {_PROPERTY} SELECT zoning, count(*) AS n_rows, count(*) FILTER (WHERE acreage IS NULL) AS null_acreage, count(*) FILTER (WHERE parcel_no IS NULL) AS null_parcel_no FROM property GROUP BY zoning")
def coverage_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.coverage(on.properties(spark, sf_dir), "zoning", "acreage", "parcel_no")


@register("SELECT min(doc_id) AS doc_id, count(*) AS n_rows, sha256(text) AS content_sha256 FROM documents GROUP BY text")
def exact_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.exact_classes(on.table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "n_rows", "content_sha256")


_SHINGLES = r"""own AS (SELECT min(doc_id) AS k, text FROM documents GROUP BY text),
w AS (SELECT k, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM own),
s AS (SELECT k, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w WHERE len(w) > 0),
x AS (SELECT k, len(g) AS n, unnest(g) AS g FROM s),
links AS (SELECT a.k AS a, b.k AS b, count(*) AS overlap, a.n AS n_a, b.n AS n_b FROM x a JOIN x b ON a.g = b.g AND a.k < b.k GROUP BY a.k, b.k, a.n, b.n HAVING 180 * count(*) >= 80 * (a.n + b.n))"""


@register(f"WITH {_SHINGLES} SELECT a, b, CAST(overlap AS INTEGER) AS overlap, CAST(n_a AS INTEGER) AS n_a, CAST(n_b AS INTEGER) AS n_b FROM links")
def near_dup_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.shingle_links(on.table(spark, sf_dir, "documents"), "doc_id", "text")


@register(f"""WITH RECURSIVE {_SHINGLES}, e AS (SELECT a, b FROM links UNION SELECT b, a FROM links), r AS (SELECT k AS n, k AS root FROM own UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.n),
c AS (SELECT n, min(root) AS cluster_id FROM r GROUP BY n) SELECT doc_id, cluster_id FROM documents d JOIN own ON own.text = d.text JOIN c ON c.n = own.k""")
def dup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = on.table(spark, sf_dir, "documents")
    return reconcile.clusters(docs, "doc_id", reconcile.spanning_links(docs, "doc_id", "text"), "text")


@register("""SELECT doc_id, content_sha256, n_chars FROM (SELECT doc_id, sha256(text) AS content_sha256, n_chars, row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r = 1""")
def canonical_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = on.table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.sha2("text", 256).alias("content_sha256"))
    return reconcile.canonical(docs, "content_sha256", "doc_id", F.col("n_chars")).select("doc_id", "content_sha256", "n_chars")


@register("SELECT lang, count(*) AS n_records, count(DISTINCT text) AS n_entities, count(*) - count(DISTINCT text) AS n_merged FROM documents GROUP BY lang")
def reconcile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile_report(on.table(spark, sf_dir, "documents").select("lang", F.sha2("text", 256).alias("id")), "lang", "id")


@register("""WITH own AS (SELECT min(p_partkey) AS k, p_name AS n FROM part GROUP BY p_name)
SELECT least(a.k, b.k) AS a, greatest(a.k, b.k) AS b, CAST(levenshtein(a.n, b.n) AS INTEGER) AS distance FROM own a JOIN own b ON split_part(a.n, ' ', 1) = split_part(b.n, ' ', 1) AND a.n < b.n WHERE levenshtein(a.n, b.n) <= 3""")
def fuzzy_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.close_names(on.table(spark, sf_dir, "part"), "p_partkey", F.col("p_name"), block_key(F.col("p_name")), 3)


@register("""WITH own AS (SELECT min(p_partkey) AS k, p_name AS n FROM part GROUP BY p_name)
SELECT least(a.k, b.k) AS a, greatest(a.k, b.k) AS b, CAST(levenshtein(a.n, b.n) AS INTEGER) AS distance FROM own a JOIN own b ON a.n < b.n AND abs(length(a.n) - length(b.n)) <= 2 WHERE levenshtein(a.n, b.n) <= 2""")
def fuzzy_names_everywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names within two edits, whatever they begin with: one block holds them all."""
    return reconcile.close_names(on.table(spark, sf_dir, "part"), "p_partkey", F.col("p_name"), F.lit(""), 2)


@register("SELECT o_custkey AS property_id, to_json(list(o_orderkey ORDER BY o_orderkey)) AS evidence FROM orders GROUP BY o_custkey")
def evidence_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on.transfers(spark, sf_dir).groupBy("property_id").agg(F.to_json(F.sort_array(F.collect_list("transfer_id"))).alias("evidence"))


@register("SELECT s_suppkey AS k FROM supplier EXCEPT SELECT l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-01-12'")
def load_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = on.table(spark, sf_dir, "lineitem").filter("l_shipdate < TIMESTAMP_NTZ'1995-01-12'").select(F.col("l_suppkey").alias("k"))
    return reconcile.load_gap(on.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), loaded, "k")


@register("SELECT c_nationkey AS k FROM customer WHERE c_acctbal >= 4000 INTERSECT SELECT s_nationkey FROM supplier")
def multi_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = on.table(spark, sf_dir, "customer").filter("c_acctbal >= 4000").select(F.col("c_nationkey").alias("k"))
    return large.intersect(on.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")))


@register("SELECT c_custkey AS party_id, c_name AS name, c_mktsegment AS category FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def unified_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = on.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("category"))
    return reconcile.unify(customers, on.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name")))


@register("SELECT doc_id, sha256(CAST(doc_id AS VARCHAR) || chr(31) || source || chr(31) || text) AS content_sha256 FROM documents")
def content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on.table(spark, sf_dir, "documents").select("doc_id", digest(F.col("doc_id"), F.col("source"), F.col("text")).alias("content_sha256"))


@register("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL THEN 'k: missing' ELSE '' END AS reasons FROM events")
def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values out of JSON payloads by casts that never fail, with the reason where there is none."""
    k = load.try_as(F.get_json_object("props", "$.k"), "int")
    return on.table(spark, sf_dir, "events").select("event_id", k.alias("k"), F.when(k.isNull(), "k: missing").otherwise("").alias("reasons"))


@register("""WITH p AS (SELECT props, CASE WHEN json_valid(props) THEN props END AS v FROM clicks), f AS (SELECT v, unnest(json_keys(v)) AS field FROM p WHERE v IS NOT NULL)
SELECT field, CASE json_type(v, '$.' || field) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind, count(*) AS n_rows FROM f GROUP BY ALL
UNION ALL SELECT NULL, CASE WHEN props IS NULL THEN 'missing' ELSE 'broken' END AS kind, count(*) FROM p WHERE v IS NULL GROUP BY ALL""")
def payload_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which kinds of value the fields of clicks' payloads have; some drift, some are broken."""
    return payloads.shapes(on.table(spark, sf_dir, "clicks"), "props")


@register("""WITH p AS (SELECT click_id, props, CASE WHEN json_valid(props) THEN props END AS v FROM clicks)
SELECT click_id, TRY_CAST(json_extract_string(v, '$.k') AS INTEGER) AS k, json_extract_string(v, '$.device.os') AS os, TRY_CAST(json_extract_string(v, '$.items[0].qty') AS INTEGER) AS qty,
  concat_ws(',', CASE WHEN props IS NOT NULL AND v IS NULL THEN '*' END, CASE WHEN json_type(v, '$.tags') NOT IN ('NULL', 'UBIGINT') THEN 'tags' END) AS set_aside FROM p""")
def payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clicks' payloads in typed columns; tags, asked for as a number, are set aside where they are a list."""
    fields = {"k": ("$.k", "int"), "os": ("$.device.os", "string"), "qty": ("$.items[0].qty", "int"), "tags": ("$.tags", "int")}
    out = payloads.typed(on.table(spark, sf_dir, "clicks"), "props", fields)
    return out.select("click_id", "k", "os", "qty", F.array_join("set_aside", ",").alias("set_aside"))


@register("SELECT vendor_id, unnest([0.5e0, 0.95e0]) AS share, unnest([quantile_disc(amount, 0.5), quantile_disc(amount, 0.95)]) AS amount FROM sale_lines WHERE amount IS NOT NULL AND vendor_id IS NOT NULL GROUP BY vendor_id")
def exact_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and 95th percentile of the amounts of each vendor, one of whom has most of the lines."""
    return selection.percentiles(on.table(spark, sf_dir, "sale_lines").filter("vendor_id is not null"), "vendor_id", "amount", (0.5, 0.95), few=1000)


_SCORED = f"""WITH {_PROPERTY}, {_TRANSFER}, l AS (SELECT property_id, CAST(date_diff('day', max(transfer_date), DATE '2001-08-02') AS DOUBLE) AS days FROM transfer GROUP BY property_id),
c AS (SELECT p.property_id, CASE WHEN acreage IS NOT NULL THEN greatest(0e0, least(1e0, CAST(acreage AS DOUBLE) / 100e0)) END AS size, CASE WHEN days IS NOT NULL THEN greatest(0e0, least(1e0, days / 1000e0)) END AS tenure FROM property p LEFT JOIN l USING (property_id)),
scored AS (SELECT property_id, CASE WHEN size IS NOT NULL OR tenure IS NOT NULL THEN (0e0 + coalesce(size * 2e0, 0e0) + coalesce(tenure * 1e0, 0e0)) / (0e0 + CASE WHEN size IS NOT NULL THEN 2e0 ELSE 0e0 END + CASE WHEN tenure IS NOT NULL THEN 1e0 ELSE 0e0 END) END AS score,
  concat_ws(',', CASE WHEN size IS NULL THEN 'size' END, CASE WHEN tenure IS NULL THEN 'tenure' END, 'power') AS missing FROM c)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = ownership.last_transfers(on.transfers(spark, sf_dir))
    both = on.properties(spark, sf_dir).join(last, "property_id", "left")
    days = F.datediff(F.lit(AS_OF), "last_transfer").cast("double")
    parts = {"size": score.bucket_rank(F.col("acreage").cast("double"), 0, 100), "tenure": score.bucket_rank(days, 0, 1000), "power": F.lit(None).cast("double")}
    return score.ranked(both, "property_id", parts, {"size": 2.0, "tenure": 1.0, "power": 1.0}, F.array(F.lit("power distance is not known")))


@register(f"{_SCORED} SELECT property_id, score, missing FROM scored")
def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("property_id", "score", F.array_join("missing", ",").alias("missing"))


@register(f"{_SCORED} SELECT property_id, score, missing, CAST(row_number() OVER (ORDER BY score DESC NULLS LAST, property_id) AS INTEGER) AS rank FROM scored ORDER BY score DESC NULLS LAST, property_id LIMIT 20")
def top_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.top(_scored(spark, sf_dir), "property_id", 20).select("property_id", "score", F.array_join("missing", ",").alias("missing"), "rank")


@register(f"{_SCORED} SELECT property_id, score FROM scored WHERE score < 0.5e0 OR (score = 0.5e0 AND property_id > 10) OR score IS NULL ORDER BY score DESC NULLS LAST, property_id LIMIT 20")
def candidate_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.page_after(_scored(spark, sf_dir), "property_id", 20, (0.5, 10)).select("property_id", "score")


@register(f"WITH {_PROPERTY}, k AS (SELECT property_id, acreage, percent_rank() OVER (ORDER BY acreage) AS percent_rank FROM property WHERE acreage IS NOT NULL) SELECT p.property_id, k.percent_rank FROM property p LEFT JOIN k USING (property_id)")
def candidate_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.percent_ranks(on.properties(spark, sf_dir).select("property_id", "acreage"), "acreage").select("property_id", "percent_rank")


@register("SELECT c_custkey AS property_id, CAST(ntile(10) OVER (ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS tile, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS position FROM customer")
def candidate_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = on.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("property_id"), "c_acctbal")
    order = (F.desc("c_acctbal"), F.asc("property_id"))
    return ranking.tiles(ranking.positions(base, *order), 10, *order).select("property_id", "tile", F.col("position").cast("long").alias("position"))


@register()
def artifact_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishes a table and lists its files with digests and content identifiers."""
    path = sinks.publish(on.properties(spark, sf_dir), shared_folder(spark), "property", "property_id")
    return sinks.eligible(sinks.manifest(spark, path, "property", "fixture"), ["property"])


_CHUNK, _FAN = 4096, 8


@register(f"""WITH RECURSIVE lines AS (SELECT substr(o_orderpriority, 1, 1) AS part, o_orderkey AS k, concat_ws('|', o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) || chr(10) AS line FROM orders),
files AS (SELECT part, string_agg(line, '' ORDER BY k) AS t FROM lines GROUP BY part), sizes AS (SELECT part, t, length(t) AS n, CAST(ceil(length(t) / {_CHUNK}.0) AS BIGINT) AS leaves FROM files),
levels AS (SELECT part, 0 AS level, leaves AS n_below, leaves AS n_here, CAST({_CHUNK} AS BIGINT) AS span, n FROM sizes UNION ALL SELECT part, level + 1, n_here, CAST(ceil(n_here / {_FAN}.0) AS BIGINT), span * {_FAN}, n FROM levels WHERE n_here > 1),
nodes AS (SELECT part, level, unnest(range(n_here)) AS i, n_below, n_here, span, n FROM levels)
SELECT part, CAST(level AS INTEGER) AS level, i, CASE WHEN level = 0 THEN 0 ELSE least({_FAN}, n_below - i * {_FAN}) END AS n_links, least(span, nodes.n - i * span) AS size, n_here = 1 AS root, CASE WHEN level = 0 THEN sha256(substr(t, CAST(i * {_CHUNK} + 1 AS BIGINT), {_CHUNK})) END AS leaf_sha256
FROM nodes JOIN sizes USING (part)""")
def artifact_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as one text file for each priority, cut into blocks: digests of chunks, and the link nodes above them."""
    folder = shared_folder(spark)
    line = F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").cast("string"))
    lines = on.table(spark, sf_dir, "orders").select(F.substring("o_orderpriority", 1, 1).alias("part"), "o_orderkey", line.alias("line"))
    lines.repartition("part").sortWithinPartitions("part", "o_orderkey").select("part", "line").write.partitionBy("part").text(folder)
    nodes, _ = artifacts.blocks(spark, folder, _CHUNK, _FAN, "*.txt")
    part = F.regexp_extract("path", "part=([^/]*)/", 1).alias("part")
    return nodes.select(part, "level", "i", "n_links", "size", "root", F.when(F.col("level") == 0, F.lower(F.hex("digest"))).alias("leaf_sha256"))


@register(f"""WITH {_PROPERTY}, {_TRANSFER}, {_PERMIT}, {_POI}, l AS (SELECT property_id, max(transfer_date) AS last_transfer, count(*) AS n FROM transfer GROUP BY property_id),
m AS (SELECT property_id, min({_metres('a', 'b')}) AS m FROM property a, poi b WHERE {_metres('a', 'b')} <= 800e0 GROUP BY property_id), s AS (SELECT property_id, count(*) AS n FROM permit WHERE upper(permit_type) = 'R' GROUP BY property_id),
b AS (SELECT p.property_id, acreage, last_transfer, coalesce(l.n, 0) AS n_transfers, concat_ws('; ', CASE WHEN m IS NOT NULL THEN 'power within ' || CAST(floor(m) AS BIGINT) || ' m' END, CASE WHEN s.n >= 20 THEN 'permits: ' || s.n END, CASE WHEN zoning = 'MACHINERY' THEN 'zoning: ' || zoning END) AS basis
  FROM property p LEFT JOIN l USING (property_id) LEFT JOIN m USING (property_id) LEFT JOIN s USING (property_id) WHERE acreage >= 60 AND NOT EXISTS (SELECT 1 FROM transfer t WHERE t.property_id = p.property_id AND t.transfer_date >= DATE '2000-08-03'))
SELECT property_id, CAST(acreage AS DOUBLE) AS acres, last_transfer, n_transfers, basis FROM b WHERE basis <> ''""")
def agent_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prompt, matched to a registered tool with its slots filled, run through the tool's own function."""
    from acreflow.serving.agent import match
    from acreflow.serving.tools import Tables, run_tool

    tables = Tables(property=on.properties(spark, sf_dir), transfer=on.transfers(spark, sf_dir), permit=on.permits(spark, sf_dir), poi=on.pois(spark, sf_dir).withColumn("kind", F.lit("power")))
    found = match("Which larger parcels of at least 60 acres have stable ownership (no recorded transfer in the last 1+ years as of 2001-08-02) and any available signals related to power or industrial suitability?")
    out = run_tool(found.tool, tables, **found.arguments, zones="MACHINERY", permit_types="R", least=20, metres=800.0)
    return out.select("property_id", F.col("acreage").cast("double").alias("acres"), "last_transfer", "n_transfers", F.array_join("basis", "; ").alias("basis"))


@register(f"""WITH {_PROPERTY}, {_TRANSFER}, l AS (SELECT property_id, max(transfer_date) AS last_transfer, count(*) AS n FROM transfer GROUP BY property_id)
SELECT property_id, concat_ws('; ', acreage || ' acres', 'last recorded transfer on ' || last_transfer, CASE WHEN coalesce(n, 0) = 0 THEN 'no recorded transfer' ELSE n || ' recorded transfers' END) AS explanation
FROM property p LEFT JOIN l USING (property_id) WHERE acreage >= 20 AND NOT EXISTS (SELECT 1 FROM transfer t WHERE t.property_id = p.property_id AND t.transfer_date >= DATE '2000-08-03')""")
def explained_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each parcel is in an answer, in words."""
    from acreflow.serving.reasons import explained
    from acreflow.serving.tools import Tables, run_tool

    tables = Tables(property=on.properties(spark, sf_dir), transfer=on.transfers(spark, sf_dir))
    return explained(run_tool("no_transfer_since", tables, years=1, as_of=AS_OF, inclusive=True, min_acres=20.0)).select("property_id", "explanation")


_CLIENT_FIELDS = (matching.Field("words", 2, True), matching.Field("email"), matching.Field("city"), matching.Field("segment"))
_CLIENT_KEYS = ((F.col, "words", "email"), (F.col, "email", "words"), (matching.longest_word, "words", "city"))


def _clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clients, one row for each id, with the words of their names."""
    one = on.table(spark, sf_dir, "clients").filter("client_id is not null").groupBy("client_id").agg(F.min(F.struct("name", "email", "city", "segment")).alias("c"))
    return one.select("client_id", matching.word_key(F.col("c.name")).alias("words"), F.lower("c.email").alias("email"), "c.city", "c.segment")


def _client_keys() -> list[tuple[Column, Column]]:
    return [(how(by) if how is F.col else how(F.col(by)), F.col(tie)) for how, by, tie in _CLIENT_KEYS]


_CLIENTS = f"""c AS (SELECT client_id AS k, list_sort(list_filter(string_split(trim(regexp_replace(upper(name), '[^A-Z0-9]+', ' ', 'g')), ' '), lambda w: w <> '' AND w NOT IN ('JR', 'SR', 'II', 'III'))) AS w, lower(email) AS email, city, segment FROM clients WHERE client_id IS NOT NULL),
r AS (SELECT k, w, nullif(array_to_string(w, ' '), '') AS words, email, city, segment FROM c),
n AS (SELECT 1 AS src, k, words AS own, email AS tie FROM r UNION ALL SELECT 2, k, email, words FROM r UNION ALL SELECT 3, k, list_sort(list_transform(w, lambda x: {{'l': -length(x), 'x': x}}))[1].x, city FROM r WHERE words IS NOT NULL),
p AS (SELECT src, k, own, row_number() OVER (PARTITION BY src ORDER BY own, tie NULLS FIRST, k) AS at FROM n WHERE own IS NOT NULL),
names AS (SELECT words, min(k) AS k FROM r WHERE words IS NOT NULL GROUP BY words),
pairs AS (SELECT least(x.k, y.k) AS a, greatest(x.k, y.k) AS b FROM names x JOIN names y ON x.words < y.words AND abs(length(x.words) - length(y.words)) <= 2 WHERE levenshtein(x.words, y.words) <= 2 UNION SELECT least(x.k, y.k) AS a, greatest(x.k, y.k) AS b FROM p x JOIN p y ON x.src = y.src AND x.own = y.own AND x.k <> y.k AND y.at BETWEEN x.at + 1 AND x.at + {matching.WIDTH})"""


@register(f"""WITH {_CLIENTS}, met AS (SELECT x.w AS wx, y.w AS wy, x.words AS wa, y.words AS wb, x.email AS ea, y.email AS eb, x.city AS ca, y.city AS cb, x.segment AS sa, y.segment AS sb FROM pairs JOIN r x ON x.k = a JOIN r y ON y.k = b),
levels AS (SELECT CASE WHEN wa IS NULL OR wb IS NULL THEN -1 WHEN wa = wb THEN 2 WHEN levenshtein(wa, wb) <= 2 OR (len(wx) = len(wy) AND list_bool_and(list_transform(range(1, len(wx) + 1), lambda i: wx[i] = wy[i] OR (length(wx[i]) = 1 AND starts_with(wy[i], wx[i])) OR (length(wy[i]) = 1 AND starts_with(wx[i], wy[i]))))) THEN 1 ELSE 0 END AS words,
  coalesce(CAST(ea = eb AS INTEGER), -1) AS email, coalesce(CAST(ca = cb AS INTEGER), -1) AS city, coalesce(CAST(sa = sb AS INTEGER), -1) AS segment FROM met)
SELECT words, email, city, segment, count(*) AS n_pairs FROM levels GROUP BY ALL""")
def match_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clients: how many pairs of neighbouring records agree in which fields, and how well; -1 is missing."""
    rows = _clients(spark, sf_dir)
    compared = matching.patterns(rows, "client_id", matching.candidates(rows, "client_id", _client_keys(), close=F.col("words")), _CLIENT_FIELDS)
    return matching.pattern_counts(compared, _CLIENT_FIELDS).fillna(-1)


@register()
def resolved_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clients as entities by learned weights; no SQL, as these are fitted in rounds.  Tests hold them against the true ones."""
    return matching.resolve(_clients(spark, sf_dir), "client", "client_id", _CLIENT_FIELDS, _client_keys(), close=F.col("words"))[0]


@register("""WITH RECURSIVE c AS (SELECT client_id AS k, name, email FROM clients WHERE client_id IS NOT NULL),
own AS (SELECT k, min(k) OVER (PARTITION BY name) AS by_name, min(k) OVER (PARTITION BY email) AS by_email, name, email FROM c),
e AS (SELECT k AS a, by_name AS b FROM own WHERE name IS NOT NULL UNION SELECT by_name, k FROM own WHERE name IS NOT NULL UNION SELECT k, by_email FROM own WHERE email IS NOT NULL UNION SELECT by_email, k FROM own WHERE email IS NOT NULL),
r AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node) SELECT node, min(root) AS component FROM r GROUP BY node""")
def components_over_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clients of one name or email, as links that three runs bring one after the other."""
    rows, folder = on.table(spark, sf_dir, "clients").filter("client_id is not null").select("client_id", "name", "email"), shared_folder(spark)
    edges = None
    for c in ("name", "email"):
        first = rows.filter(F.col(c).isNotNull()).groupBy(c).agg(F.min("client_id").alias("b"))
        own = rows.join(first, c).select(F.col("client_id").alias("a"), "b")
        edges = own if edges is None else edges.unionByName(own)
    for r in range(3):
        labels.extend(spark, folder, edges.filter(F.col("a") % 3 == r), "a", "b")
    return labels.labels(spark, folder)


_NAME = "regexp_replace(upper({0}), '^[A-Z]+#0*', 'FIRM ')"


@register(f"SELECT c_custkey AS owner_id, c_name AS name, s_suppkey AS business_id, s_name AS business_name FROM customer LEFT JOIN supplier ON {_NAME.format('c_name')} = {_NAME.format('s_name')}")
def owner_businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as owners and supplier as businesses, joined through the entity map of both; names tell by their numbers."""
    owners = on.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("owner_id"), F.col("c_name").alias("name"))
    firms = on.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("business_id"), F.col("s_name").alias("name"))
    name = F.regexp_replace(F.upper("name"), "^[A-Z]+#0*", "FIRM ")
    entities = links.entity_map(owners, "owner", "owner_id", name).unionByName(links.entity_map(firms, "business", "business_id", name))
    return links.owner_businesses(owners, firms, entities)


@register(f"""WITH {_PROPERTY}, z AS (SELECT o_custkey AS property_id, o_orderpriority AS zoning_code, o_orderstatus AS land_use_code, CAST(o_orderdate AS DATE) AS zoned_on FROM orders WHERE o_orderkey % 5 <> 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderpriority DESC, o_orderstatus DESC) = 1)
SELECT property_id, parcel_no, zoning_code, land_use_code, zoned_on FROM property LEFT JOIN z USING (property_id)""")
def zoned_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as zoning rows, priority as code; every fifth only links to its source."""
    zoning = on.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("property_id"), F.col("o_orderpriority").alias("zoning_code"), F.col("o_orderstatus").alias("land_use_code"), F.to_date("o_orderdate").alias("effective_date"), (F.col("o_orderkey") % 5 == 0).alias("link_only"))
    return links.with_zoning(on.properties(spark, sf_dir), zoning).select("property_id", "parcel_no", "zoning_code", "land_use_code", "zoned_on")


@register("SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path, nullif(regexp_extract(url, '[?]([^#]*)', 1), '') AS query FROM pages")
def source_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return on.table(spark, sf_dir, "pages").select("page_id", url_part(url, "HOST").alias("host"), url_part(url, "PATH").alias("path"), url_part(url, "QUERY").alias("query"))


@register(f"""WITH {_PROPERTY}, {_POI}, n AS (SELECT DISTINCT property_id FROM property a, poi b WHERE {_metres('a', 'b')} <= 800e0)
SELECT p.property_id, CASE p.property_id % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE n.property_id IS NOT NULL END AS water_view, CASE WHEN p.property_id % 3 < 2 THEN 'source' ELSE 'nearness (assumed)' END AS water_basis FROM property p LEFT JOIN n USING (property_id)""")
def water_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as water; two of three parcels have a flag of their source."""
    parcels = on.properties(spark, sf_dir).withColumn("flag", F.when(F.col("property_id") % 3 == 0, True).when(F.col("property_id") % 3 == 1, False))
    return links.water_view(parcels, on.pois(spark, sf_dir), 800.0, MAX_LAT, "flag").select("property_id", "water_view", "water_basis")


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Loads customer, kept as CSV with every seventh key malformed, through a run; the folder and the run's id."""
    folder = shared_folder(spark)
    key = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("x"), "c_custkey")).otherwise(F.col("c_custkey").cast("string"))
    on.table(spark, sf_dir, "customer").select(key.alias("k"), "c_name", "c_mktsegment").write.csv(f"{folder}/raw", header=True)
    names = {"business_id": "k", "name": "c_name", "category": "c_mktsegment"}
    source = run.Source("customer", "business", lambda s, r: load.load(s, "business", f"{folder}/raw", "customer", r, fmt="csv", names=names), "a stand-in")
    return folder, run.run(spark, [source], folder)


@register("SELECT c_custkey AS business_id, c_name AS name, c_mktsegment AS category, 'customer' AS source_id, CAST(c_custkey AS VARCHAR) AS source_record_id, sha256(CAST(c_custkey AS VARCHAR) || chr(31) || c_name || chr(31) || c_mktsegment) AS content_sha256 FROM customer WHERE c_custkey % 7 <> 0")
def loaded_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run loaded, published and read back, with provenance."""
    folder, run_id = _loaded(spark, sf_dir)
    good = spark.read.parquet(f"{folder}/business/run={run_id}/source=customer")
    back = spark.read.parquet(sinks.publish(good, f"{folder}/published", "business", "business_id"))
    return back.select("business_id", "name", "category", "prov.source_id", "prov.source_record_id", "prov.content_sha256")


@register("SELECT c_custkey AS property_id, c_name AS parcel_no, CAST(c_acctbal AS DECIMAL(12,4)) AS acreage FROM customer WHERE c_acctbal >= 0")
def published_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer, published in part, then by a run that fails between files, then whole: what a reader gets in the end."""
    folder = shared_folder(spark)
    rows = on.table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("property_id"), F.col("c_name").alias("parcel_no"), F.col("c_acctbal").cast("decimal(12,4)").alias("acreage"))
    sinks.publish_snapshot(rows.filter("property_id % 2 = 0"), folder, "property", "property_id")
    before = sinks.published(spark, folder, "property").count()
    try:
        sinks.publish_snapshot(rows.withColumn("parcel_no", F.when(F.col("property_id") % 50 == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("parcel_no"))), folder, "property", "property_id")
    except Exception as e:
        if "lost" not in str(e):
            raise
    if sinks.published(spark, folder, "property").count() != before:
        raise RuntimeError("a broken run has changed what was published")
    sinks.publish_snapshot(rows, folder, "property", "property_id")
    sinks.retire(spark, folder, "property")
    return sinks.published(spark, folder, "property")


@register("SELECT c_custkey AS contractor_id, upper(c_name) AS name, true AS one_file, c_name AS raw_name, c_acctbal AS raw_balance FROM customer")
def record_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published records led back to the file and row that they were loaded from."""
    folder, path = shared_folder(spark), f"{sf_dir}/customer.parquet"
    good, _ = load.load(spark, "contractor", path, "customer", "fixture", names={"contractor_id": "c_custkey", "name": "c_name"})
    sinks.publish_snapshot(good.withColumn("name", F.upper("name")), folder, "contractor", "contractor_id")
    records = sinks.published(spark, folder, "contractor")
    found = load.raw_rows(records, load.read_raw(spark, path), "contractor_id").join(records.select("contractor_id", "name"), "contractor_id")
    return found.select("contractor_id", "name", F.col("source_file").contains("customer").alias("one_file"), F.col("raw.c_name").alias("raw_name"), F.col("raw.c_acctbal").alias("raw_balance"))


@register("SELECT 'x' || c_custkey AS k, 'business_id: not a long; business_id: missing' AS reasons FROM customer WHERE c_custkey % 7 = 0")
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run set aside, with the reasons."""
    folder, run_id = _loaded(spark, sf_dir)
    bad = spark.read.parquet(f"{folder}/_rejected/business/run={run_id}/source=customer")
    return bad.select(F.get_json_object("raw", "$.k").alias("k"), F.array_join("reasons", "; ").alias("reasons"))


@register("SELECT 'customer' AS source_id, CAST(1 AS BIGINT) AS n_stages, count(*) FILTER (WHERE c_custkey % 7 <> 0) AS n_rows, count(*) FILTER (WHERE c_custkey % 7 = 0) AS n_errors, 'a stand-in' AS limitations FROM customer")
def load_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a run from its own log."""
    folder, run_id = _loaded(spark, sf_dir)
    out = runlog.run_summary(run.read_log(spark, folder).filter(F.col("run_id") == run_id), "source_id")
    return out.select("source_id", "n_stages", "n_rows", "n_errors", F.array_join("limitations", "; ").alias("limitations"))
