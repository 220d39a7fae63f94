import base64
import datetime as dt
import itertools
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from acreflow import queries
from acreflow.functions.columns import acres, haversine_m, normal_name, years_before
from acreflow.functions.content_id import cid_of_digest
from acreflow.operators import assemblages, links, ownership, permits, proximity, ranking, reconcile, runlog, score
from acreflow.operators.components import connected_components

D = dt.date
SLOW = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def parcels(spark, data):
    return spark.createDataFrame(data, "property_id long, acreage decimal(12,4), owner_id long, zoning string, lat double, lon double")


def moves(spark, data):
    return spark.createDataFrame(data, "transfer_id long, property_id long, transfer_date date")


def test_years_before_leap_day():
    assert years_before(D(2024, 2, 29), 1) == D(2023, 2, 28)
    assert years_before(D(2025, 1, 1), 10) == D(2015, 1, 1)


def test_tenure_boundary_is_strict_unless_inclusive(spark):
    p = spark.range(1, 5).withColumnRenamed("id", "property_id")
    t = moves(spark, [(1, 1, D(2015, 1, 1)), (2, 2, D(2014, 12, 31)), (3, 3, D(2015, 1, 2)), (4, 1, D(2001, 1, 1)), (5, 2, None)])
    assert rows(ownership.tenure_over(p, t, D(2025, 1, 1), 10), "property_id") == [(2,)]
    assert rows(ownership.tenure_over(p, t, D(2025, 1, 1), 10, inclusive=True), "property_id") == [(1,), (2,)]
    assert rows(ownership.no_transfer_since(p, t, D(2015, 1, 1)), "property_id") == [(2,), (4,)]


def test_tenure_limit_reaches_the_scan(spark, tmp_path):
    moves(spark, [(1, 1, D(2015, 1, 1))]).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    plan = ownership.owner_as_of(t, D(2016, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(transfer_date,2016-01-01)" in plan


def test_owner_as_of_and_current_owner_break_ties_by_id(spark):
    t = moves(spark, [(1, 1, D(2000, 1, 1)), (2, 1, D(2000, 1, 1)), (3, 1, D(2010, 1, 1)), (4, 2, None)])
    assert rows(ownership.owner_as_of(t, D(2005, 1, 1)), "property_id", "transfer_id") == [(1, 2)]
    assert rows(ownership.current_owner(t), "property_id", "transfer_id") == [(1, 3)]


@SLOW
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 400)), max_size=12), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 400), st.integers(0, 50)), max_size=12))
def test_as_of_join_equals_brute_force(spark, left, right):
    day = lambda n: D(2000, 1, 1) + dt.timedelta(n)
    a = spark.createDataFrame([(k, day(t), i) for i, (k, t) in enumerate(left)], "k long, t date, i long")
    b = spark.createDataFrame([(k, day(t), v) for k, t, v in right], "k long, u date, v long")
    got = dict(rows(ownership.as_of_join(a, b, "k", "t", "u", "v"), "i", "v"))
    for i, (k, t) in enumerate(left):
        before = [(u, v) for q, u, v in right if q == k and u <= t]
        assert got[i] == (max(before)[1] if before else None)


def test_as_of_join_keeps_left_rows_with_nulls(spark):
    a = spark.createDataFrame([(None, D(2000, 1, 1), 1), (1, None, 2)], "k long, t date, i long")
    b = spark.createDataFrame([(1, D(1999, 1, 1), 7)], "k long, u date, v long")
    assert rows(ownership.as_of_join(a, b, "k", "t", "u", "v"), "i", "v") == [(1, None), (2, None)]


def test_stability(spark):
    t = moves(spark, [(1, 1, D(2000, 1, 1)), (2, 1, D(2000, 1, 11)), (3, 2, D(2000, 1, 1))])
    assert rows(ownership.ownership_stability(t, D(2000, 1, 21)), "property_id", "n_transfers", "tenure_days", "mean_days_held") == [(1, 2, 10, 10.0), (2, 1, 20, 20.0)]


def test_owner_area_with_unknowns(spark):
    df = spark.createDataFrame(
        [(1, "61201", "a", "IL", "61201", "b", "IL"), (2, "1", "a", "IL", "2", "a", "IL"), (3, "1", "a", "IL", "2", "b", "IL"), (4, "1", "a", "IL", "2", "a", "IA"), (5, None, None, None, "2", "a", "IL")],
        "id int, mz string, mc string, ms string, sz string, sc string, ss string",
    )
    out = ownership.owner_area(df, {"zip": "mz", "city": "mc", "state": "ms"}, {"zip": "sz", "city": "sc", "state": "ss"})
    assert [r[1] for r in rows(out, "id", "owner_area")] == ["local", "local", "regional", "out_of_area", "unknown"]


def test_roof_age_is_three_valued(spark):
    p = spark.createDataFrame([(1, None), (2, 1990), (3, None), (4, 2020)], "property_id long, year_built int")
    q = spark.createDataFrame([(1, "roof", D(2020, 1, 1)), (1, "roof", D(2001, 1, 1)), (2, "fence", D(2020, 1, 1)), (4, "roof", None)], "property_id long, permit_type string, issued_date date")
    out = permits.roof_age(p, q, D(2025, 1, 1), 15, F.col("permit_type") == "roof")
    assert rows(out, "property_id", "old_roof", "roof_source") == [(1, False, "permit"), (2, True, "year_built (assumed)"), (3, None, None), (4, False, "year_built (assumed)")]


def test_industrial_signal_basis_and_unknown(spark):
    p = parcels(spark, [(1, None, 1, "M-1", 0.0, 0.0), (2, None, 1, None, 0.0, 0.0), (3, None, 1, None, 0.0, 0.0), (4, None, 1, "R-1", 0.0, 0.0)])
    q = spark.createDataFrame([(2, "WAREHOUSE", D(2020, 1, 1))], "property_id long, permit_type string, issued_date date")
    out = permits.industrial_signal(p, q, F.col("permit_type") == "WAREHOUSE", ("M-1",))
    assert [r[1] for r in rows(out, "property_id", "industrial")] == [True, True, None, False]
    assert {r[0]: r[1] for r in rows(out, "property_id", "basis")}[2] == ["permits: 1"]


def metres(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371008.8 * math.asin(math.sqrt(min(1, h)))


@SLOW
@given(st.lists(st.tuples(st.floats(40, 42), st.floats(-180, 180)), min_size=1, max_size=12), st.lists(st.tuples(st.floats(40, 42), st.floats(-180, 180)), min_size=1, max_size=12), st.sampled_from([500.0, 50_000.0, 900_000.0]))
def test_grid_join_equals_brute_force(spark, left, right, radius):
    left = left + [(41.0, 179.999), (41.0, -179.999)]
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(left)], "a long, lat double, lon double")
    b = spark.createDataFrame([(i, *p) for i, p in enumerate([*right, (41.0, -179.9995)])], "b long, lat double, lon double")
    got = set(rows(proximity.within(a, b, radius, 42.0), "a", "b"))
    far = {(i, j): metres(p, q) for (i, p), (j, q) in itertools.product(enumerate(left), enumerate([*right, (41.0, -179.9995)]))}
    assert got <= {k for k, m in far.items() if m <= radius + 1e-3} and got >= {k for k, m in far.items() if m <= radius - 1e-3}


def test_nearest_widens_and_ignores_bad_points(spark):
    a = spark.createDataFrame([(1, 41.0, -90.0), (2, 41.0, -95.0), (3, None, 1.0), (4, 0.0, 0.0)], "a long, lat double, lon double")
    b = spark.createDataFrame([(7, 41.001, -90.0), (6, 41.001, -90.0), (5, 41.0, -91.0)], "b long, lat double, lon double")
    assert rows(proximity.nearest(a, b, "a", "b", 500.0), "a", "b") == [(1, 6), (2, 5)]
    assert rows(proximity.nearest(a, b, "a", "b", 500.0, bounded=True), "a", "b") == [(1, 6)]
    assert rows(proximity.near(a, b, "a", 500.0), "a") == [(1,)]
    assert not rows(proximity.nearest(a, b.limit(0), "a", "b", 500.0), "a")
    far = a.unionByName(spark.createDataFrame([(9, 41.0, 90.0)], "a long, lat double, lon double"))
    got = {r["a"]: (r["b"], r["distance_m"] is None) for r in proximity.nearest(far, b, "a", "b", 50_000.0).collect()}
    assert got == {1: (6, False), 2: (5, False), 9: (None, True)}


def test_nearest_compares_points_not_rows(spark, monkeypatch):
    """Rows that share a point are compared once, and each gets the point's nearest place."""
    a = spark.createDataFrame([(i, 41.0 + (i % 2), -90.0) for i in range(40)] + [(90, 41.0, -90.0), (90, 43.0, -90.0), (91, 43.0, -90.0)], "a long, lat double, lon double")
    b = spark.createDataFrame([(i, 41.001, -90.0) for i in range(30, 60)], "b long, lat double, lon double")
    met, within = [], proximity.within
    monkeypatch.setattr(proximity, "within", lambda *x, **y: (met.append(n.count()), n)[1] if (n := within(*x, **y)) is not None else None)
    got = {r["a"]: r["b"] for r in proximity.nearest(a, b, "a", "b", 500.0, bounded=True).collect()}
    assert got == {i: 30 for i in (*range(0, 40, 2), 90)} and met == [1]
    got = {r["a"]: r["b"] for r in proximity.nearest(a, b, "a", "b", 200_000.0).collect()}
    assert got == dict.fromkeys((*range(40), 90, 91), 30)
    assert proximity.near(a, b, "a", 500.0).count() == 21


def test_nearest_of_dense_points_equals_brute_force(spark):
    left, right = [(41.0 + i * 1e-3, -90.0 + j * 1e-3) for i in range(8) for j in range(6)], [(41.0005 + i * 1e-3, -89.9995 + j * 1e-3) for i in range(7) for j in range(5)]
    a = spark.createDataFrame([(i, *p) for i, p in enumerate([*left, (41.0, -91.0), (0.0, 0.0)])], "property_id long, lat double, lon double")
    b = spark.createDataFrame([(str(900 - i), *p) for i, p in enumerate([*right, *right])], "poi_id string, lat double, lon double")
    far = {i: {str(900 - len(right) - j): metres(p, q) for j, q in enumerate(right)} for i, p in enumerate(left)}
    got = {r["property_id"]: r["distance_m"] for r in proximity.distance_to_nearest(a, b, "property_id", 2000.0).collect()}
    assert got.keys() == far.keys() and all(abs(got[i] - min(m.values())) < 1e-6 for i, m in far.items())
    for out in (proximity.nearest(a, b, "property_id", "poi_id", 2000.0, bounded=True), proximity.nearest(a.filter("property_id < 48"), b, "property_id", "poi_id", 60.0)):
        found = {r["property_id"]: (r["poi_id"], r["distance_m"]) for r in out.collect()}
        assert found.keys() == far.keys() and all(abs(m - got[i]) < 1e-6 and abs(far[i][k] - m) < 1e-6 for i, (k, m) in found.items())


def test_nearness_to_power_and_water_sorts_no_pairs(spark):
    """The least distance is kept as pairs are made, so no task gathers and sorts the pairs of dense points."""
    p, b = parcels(spark, [(1, None, 1, "", 41.0, -90.0)]), spark.createDataFrame([(7, 41.001, -90.0)], "poi_id long, lat double, lon double")
    issued = spark.createDataFrame([(1, "x", dt.date(2020, 1, 1))], "property_id long, permit_type string, issued_date date")
    for out in (links.power_or_industrial(p, issued, b, F.col("permit_type") == "x", (), 1, 2000.0), links.water_view(p, b, 2000.0)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_nearest_of_equally_near_ones_is_the_smallest_key(spark):
    a = spark.createDataFrame([(1, 41.0, 0.0)], "a long, lat double, lon double")
    for kind, keys in (("long", (9, 5, 7)), ("string", ("9", "5", "7"))):
        b = spark.createDataFrame([(k, 41.0, lon) for k, lon in zip(keys, (0.5, -0.5, 0.6), strict=True)], f"b {kind}, lat double, lon double")
        assert rows(proximity.nearest(a, b, "a", "b", 90_000.0, bounded=True), "b") == rows(proximity.nearest(a, b, "a", "b", 9_000.0), "b") == [(keys[1],)]


def test_within_by_a_further_key(spark):
    a = spark.createDataFrame([(1, "x", 41.0, -90.0), (2, "y", 41.0, -90.0), (3, None, 41.0, -90.0)], "a long, o string, lat double, lon double")
    b = spark.createDataFrame([(7, "x", 41.001, -90.0), (8, None, 41.001, -90.0), (9, "y", 44.0, -90.0)], "b long, o string, lat double, lon double")
    assert rows(proximity.within(a, b, 500.0, on=("o",)), "a", "b") == [(1, 7)]
    assert sorted(r["a"] for r in proximity.near(a, b, "a", 500.0).collect()) == [1, 2, 3] and proximity.near(a, b, "a", 500.0).columns == a.columns


def test_grid_join_has_no_nested_loop(spark):
    a = spark.createDataFrame([(1, 41.0, -90.0)], "a long, lat double, lon double")
    b = spark.createDataFrame([(7, 41.0, -90.0)], "b long, lat double, lon double")
    plan = proximity.within(a, b, 500.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_haversine(spark):
    m = spark.range(1).select(haversine_m(F.lit(41.5), F.lit(-90.5), F.lit(41.6), F.lit(-90.4))).first()[0]
    assert abs(m - metres((41.5, -90.5), (41.6, -90.4))) < 1e-6


@SLOW
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components_equal_union_find(spark, edges):
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b"), "node", "component"))
    parent = list(range(26))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(None, 5), (3, 3)]
    got = dict(rows(connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b"), "node", "component"))
    assert {got[i] for i in range(301)} == {0} and {got[i] for i in range(1000, 1400)} == {1000} and len(got) == 701


def test_assemblages_sum_exactly(spark):
    from decimal import Decimal

    p = parcels(spark, [(1, Decimal("30.1"), 1, "", 41.0, -90.0), (2, Decimal("10.2"), 1, "", 41.001, -90.0), (3, None, 1, "", 41.002, -90.0), (4, Decimal("99"), 2, "", 41.0, -90.0), (5, Decimal("50"), 1, "", 42.0, -90.0), (6, Decimal("50"), None, "", 41.0, -90.0)])
    out = assemblages.assemblages(p, 200.0, 40.0)
    assert rows(out, "assemblage_id", "n_parcels", "acreage", "n_unknown", "members") == [(1, 3, Decimal("40.3000"), 1, [1, 2, 3])]
    assert dict(rows(assemblages.assemblage_of(p, 200.0), "property_id", "assemblage_id"))[4] == 4


def test_parcels_at_one_point_are_no_pairs(spark):
    """Parcels of one point are one spot: edges follow the points, entities stay those of all pairs."""
    from decimal import Decimal

    many = [(i, Decimal("1"), 1, "", 41.0 + (i % 2) * 0.001, -90.0) for i in range(10, 90)] + [(i, Decimal("1"), 1, "", 45.0, -90.0) for i in (3, 4)] + [(5, Decimal("1"), None, "", 41.0, -90.0), (6, Decimal("1"), 1, "", 0.0, 0.0)]
    p = parcels(spark, many)
    assert assemblages.adjacent_spots(p, 200.0).count() == 1
    got = dict(rows(assemblages.assemblage_of(p, 200.0), "property_id", "assemblage_id"))
    assert {got[i] for i in range(10, 90)} == {10} and (got[3], got[4], got[5], got[6]) == (3, 3, 5, 6)
    both = parcels(spark, [(1, Decimal("1"), 1, "", 41.0, -90.0), (2, Decimal("1"), 1, "", 41.0, -90.0), (2, Decimal("1"), 1, "", 44.0, -90.0), (3, Decimal("1"), 1, "", 44.0, -90.0)])
    assert set(rows(assemblages.assemblage_of(both, 200.0), "property_id", "assemblage_id")) == {(1, 1), (2, 1), (3, 1)}


def test_texts_that_share_too_little_are_dropped(spark, monkeypatch):
    """Of texts that have a passage in common only those that may link are compared, and all links are found."""
    passage, body = [f"p{i}" for i in range(30)], [f"b{i}" for i in range(100)]
    texts = [" ".join([*passage, *(f"x{i}_{j}" for j in range(40))]) for i in range(20)] + [" ".join(body), " ".join([*body, "more"]), "one two", None, " "]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    kept, stored = {}, reconcile.stored
    monkeypatch.setattr(reconcile, "stored", lambda x, name: kept.setdefault(name, stored(x, name)))
    monkeypatch.setattr(reconcile, "forget", lambda *x: None)
    assert [tuple(r) for r in reconcile.shingle_links(df, "k", "t").collect()] == [(20, 21, 96, 96, 97)]
    assert kept["sets"].count() == 23 and {r["k"] for r in kept["shared"].collect()} == {20, 21}


def test_names_and_acres(spark):
    df = spark.createDataFrame([("Smith & Sons, L.L.C.",), ("SMITH SONS LLC",), ("  smith   sons ",)], "n string")
    assert {r[0] for r in df.select(normal_name(F.col("n"))).collect()} == {"SMITH SONS"}
    assert str(spark.range(1).select(acres(F.lit(87120))).first()[0]) == "2.0000"


def test_close_names_link_representatives_once(spark):
    df = spark.createDataFrame([(1, "acme one"), (2, "acme one"), (3, "acme ont"), (4, "other one"), (5, None), (6, "acme twenty")], "k long, n string")
    out = reconcile.close_names(df, "k", F.col("n"), F.split("n", " ")[0], 2)
    assert rows(out, "a", "b", "distance") == [(1, 3, 1)]


def test_shingle_links_equal_brute_force_and_clusters_chain(spark):
    import random

    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(14):
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(60)] = f"x{rng.randrange(99)}"
        texts.append(" ".join(t))
    texts += ["", None, "a b", "a b", "a  B", texts[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    sets = {}
    for i, t in enumerate(texts):
        w = (t or "").lower().split()
        if w:
            sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
    first = {t: min(i for i, u in enumerate(texts) if u == t) for t in texts if t}
    reps = sorted(set(first.values()))
    want = [(a, b) for a in reps for b in reps if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    links = reconcile.shingle_links(df, "k", "t")
    assert rows(links, "a", "b") == sorted(want, key=repr)
    got = dict(rows(reconcile.clusters(df, "k", links, "t"), "k", "cluster_id"))
    assert got[19] == got[0] and got[16] == got[17] == got[18] == 16 and got[15] == 15


def test_clusters_of_near_copies_take_links_in_proportion(spark, tmp_path, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base[:i], f"x{i}", *base[i + 1 :]]) for i in range(0, 180, 3)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert reconcile.shingle_links(docs, "doc_id", "text").count() == 60 * 59 // 2
    seen, components = [], reconcile.connected_components
    monkeypatch.setattr(reconcile, "connected_components", lambda e, *x: (seen.append(e.count()), components(e, *x))[1])
    assert {r["cluster_id"] for r in queries.QUERIES["dup_clusters"](spark, str(tmp_path)).collect()} == {0}
    assert max(seen) <= 4 * 60


def test_spanning_links_join_what_all_links_join(spark):
    import random

    for percent, seed in ((80, 1), (50, 2)):
        rng, texts = random.Random(seed), []
        for g in range(6):
            shared = [f"p{g // 2}_{i}" for i in range(rng.randrange(30))]
            at = shared + [f"w{g}_{i}" for i in range(rng.randrange(1, 40))]
            for _ in range(14):
                at = list(at) if rng.random() < 0.6 else shared + [f"w{g}_{i}" for i in range(rng.randrange(1, 40))]
                for _ in range(rng.randrange(3)):
                    at[rng.randrange(len(at))] = f"x{rng.randrange(99)}"
                texts.append(" ".join(at))
        df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", None, " ", "A b", "a B"])], "k long, t string")
        sets = {}
        for i, t in df.collect():
            w = (t or "").lower().split()
            if w and t not in [x for x, _ in sets.values()]:
                sets[i] = (t, {tuple(w[j : j + 3]) for j in range(max(1, len(w) - 2))})
        want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a][1] & sets[b][1]) >= percent * len(sets[a][1] | sets[b][1])}
        some = {(r["a"], r["b"]) for r in reconcile.spanning_links(df, "k", "t", 3, percent).collect()}
        assert some <= want and len(want) > 9

        def groups(links, sets=sets):
            low = {k: k for k in sets}
            for _ in sets:
                for a, b in links:
                    low[a] = low[b] = min(low[a], low[b])
            return low

        assert groups(some) == groups(want)


def test_canonical_and_report(spark):
    df = spark.createDataFrame([(1, "c", 2, "x"), (2, "c", 3, "x"), (3, "c", 3, "x"), (4, "d", 1, "x")], "k long, c string, n int, kind string")
    assert rows(reconcile.canonical(df, "c", "k", F.col("n")), "k") == [(2,), (4,)]
    assert rows(reconcile.reconcile_report(df, "kind", "c"), "n_records", "n_entities", "n_merged") == [(4, 2, 2)]
    assert rows(reconcile.load_gap(df, df.filter("k < 3"), "k"), "k") == [(3,), (4,)]
    assert reconcile.unify(df, df.drop("n")).filter("n is null").count() == 4


def test_scores_use_what_is_known(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, None, 0.5), (3, None, None)], "k long, a double, b double")
    out = score.ranked(df, "k", {"a": F.col("a"), "b": F.col("b")}, {"a": 3.0, "b": 1.0})
    assert rows(out, "k", "score", "missing") == [(1, 0.75, []), (2, 0.5, ["a"]), (3, None, ["a", "b"])]
    assert [r["k"] for r in score.top(out, "k", 2).orderBy("rank").collect()] == [1, 2]
    pages, last = [], None
    for _ in range(3):
        page = score.page_after(out, "k", 1, last).collect()
        pages += [r["k"] for r in page]
        last = (page[-1]["score"], page[-1]["k"])
    assert pages == [1, 2, 3]


def test_global_positions_and_percent_ranks(spark):
    import random

    rng = random.Random(1)
    data = [(i, rng.randrange(20) if i % 9 else None) for i in range(200)]
    df = spark.createDataFrame(data, "k long, v long").repartition(7)
    known = sorted(v for _, v in data if v is not None)
    for k, v in rows(ranking.percent_ranks(df, "v").join(df.select("k"), "k"), "k", "percent_rank"):
        own = dict(data)[k]
        assert v == (None if own is None else known.index(own) / (len(known) - 1))
    got = dict(rows(ranking.positions(df, F.asc_nulls_last("v"), F.asc("k")), "k", "position"))
    assert [k for k, _ in sorted(got.items(), key=lambda x: x[1])] == [k for k, v in sorted(data, key=lambda r: (r[1] is None, r[1] or 0, r[0]))]
    sizes = [r[1] for r in rows(ranking.tiles(df, 7, F.asc("k")).groupBy("tile").count(), "tile", "count")]
    assert sizes == [29, 29, 29, 29, 28, 28, 28]


def test_run_reports(spark):
    t = dt.datetime
    log = spark.createDataFrame([("r", "s", "load", t(2020, 1, 1), t(2020, 1, 1, 0, 1), 5, 0, None), ("r", "s", "parse", t(2020, 1, 1), t(2020, 1, 1, 0, 2), 6, 1, "slow site")], "run_id string, source_id string, stage string, started_at timestamp_ntz, ended_at timestamp_ntz, n_rows long, n_errors long, limitation string")
    assert rows(runlog.run_summary(log, "run_id", "source_id"), "n_rows", "n_errors", "p95_seconds", "limitations") == [(11, 1, 120.0, ["slow site"])]
    assert rows(runlog.coverage(log, "source_id", "limitation"), "n_rows", "null_limitation") == [(2, 1)]


def test_content_id_is_stable_and_changes_with_content():
    import hashlib

    a, b = (cid_of_digest(hashlib.sha256(x).hexdigest()) for x in (b"hello world", b"hello worle"))
    raw = base64.b32decode(a[1:].upper() + "=" * (-len(a[1:]) % 8))
    assert a.startswith("bafkrei") and raw == bytes([1, 0x55, 0x12, 32]) + hashlib.sha256(b"hello world").digest() and a != b and cid_of_digest(None) is None


def test_evidence_is_json(spark):
    out = score.with_evidence(spark.range(1), {"id": F.col("id"), "x": F.lit("y")}).first()["evidence"]
    assert json.loads(out) == {"id": 0, "x": "y"}


def test_components_raise_instead_of_truncating(spark, monkeypatch):
    from acreflow.operators import components

    monkeypatch.setattr(components, "MAX_ROUNDS", 1)
    with pytest.raises(RuntimeError):
        connected_components(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long"), "a", "b")
