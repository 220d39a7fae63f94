"""Sessions against a plain loop over each client's clicks, over blocks of all sizes, and against the SQL."""

import datetime as dt
import hashlib
import random

import duckdb
import numpy as np
import pytest

from acreflow.llm import sessions as S

DAY = dt.datetime(2024, 3, 30)
SCHEMA = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"
COLUMNS = ("client_id", "session_id", "start_us", "end_us", "n_clicks", "n_late", "value_cents", "closed_by", "path_sha256")


def us(t):
    return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def plain(rows):
    """Every client's clicks one after the other."""
    once, out = {}, []
    for c, ts, arrived, client, kind, value, *_ in rows:
        if None in (c, ts, client):
            continue
        cell = (us(ts), client, arrived is not None and us(arrived) - us(ts) > S.LATE, kind == "purchase" and value is not None and value >= 60, int(np.floor(100 * value + 0.5)) if value is not None else 0)
        once[c] = min(once.get(c, cell), cell)
    for client in {x[1] for x in once.values()}:
        clicks = sorted((t, c, final, cents) for c, (t, k, late, final, cents) in once.items() if k == client and not late)
        own, last = [], None
        for t, c, final, cents in clicks:
            why = None if last is None else "end" if last[2] else "gap" if t - last[0] >= S.GAP else "length" if t - own[-1]["start_us"] > S.LENGTH else None
            if last is None or why:
                if own:
                    own[-1]["closed_by"] = why
                own.append({"client_id": client, "session_id": c, "start_us": t, "n_clicks": 0, "n_late": 0, "value_cents": 0, "path": []})
            s = own[-1]
            s["end_us"], s["n_clicks"], s["value_cents"] = t, s["n_clicks"] + 1, s["value_cents"] + cents
            s["path"].append(str(c))
            last = (t, c, final)
        if own:
            own[-1]["closed_by"] = "end" if last[2] else "none"
        for t, k, late, _, _ in once.values():
            before = [s for s in own if s["start_us"] <= t]
            if late and k == client and before:
                before[-1]["n_late"] += 1
        for s in own:
            s["path_sha256"] = hashlib.sha256(",".join(s.pop("path")).encode()).hexdigest()
        out += own
    return sorted(tuple(s[c] for c in COLUMNS) for s in out)


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r[c] for c in COLUMNS) for r in S.sessions(df, **more).collect())


def random_rows(seed, n, clients, step, final=0.05, late=0.1):
    rng, rows, at = random.Random(seed), [], 0.0
    for i in range(n):
        at += rng.choice([0, 0, step, step, step, 2 * step, 301 if rng.random() < 0.02 else 1])
        ts = DAY + dt.timedelta(seconds=at)
        client = rng.choice([*range(clients), 0, 0])
        kind = "purchase" if rng.random() < final else rng.choice(["click", "view", None])
        arrived = None if rng.random() < 0.05 else ts + dt.timedelta(minutes=rng.choice([0, 60, 61, 500]) if rng.random() < late else 0)
        rows.append((i, ts, arrived, client if rng.random() < 0.98 else None, kind, rng.choice([None, 60.0, 59.995, 12.345, -3.3]), "{}"))
    return rows + rng.sample(rows, n // 20)


@pytest.mark.parametrize(("seed", "clients", "step", "final", "block"), [(1, 3, 40, 0.05, 1 << 17), (2, 2, 90, 0.02, 7), (3, 1, 200, 0.0, 20), (4, 1, 30, 0.0, 25), (6, 1, 3, 0.3, 6)])
def test_against_a_loop(spark, seed, clients, step, final, block):
    rows = random_rows(seed, 150, clients, step, final)
    assert found(spark, rows, block=block) == plain(rows)


def test_blocks_without_any_break(spark):
    """One client, no gap and no final click: every block is all head, and states are hopped through all of them."""
    rows = [(i, DAY + dt.timedelta(minutes=4 * i), None, 7, "click", 1.0, None) for i in range(120)]
    late = [(1000 + i, DAY + dt.timedelta(minutes=4 * i, seconds=1), DAY + dt.timedelta(days=9), 7, "view", 1.0, None) for i in range(40, 70)]
    assert found(spark, rows + late, block=20) == plain(rows + late)
    assert {r[7] for r in plain(rows)} == {"length", "none"}


def test_odd_rows(spark):
    assert found(spark, []) == []
    one = (1, DAY, DAY, 5, "purchase", 60.0, None)
    nulls = [(None, DAY, DAY, 5, "x", 1.0, None), (2, None, DAY, 5, "x", 1.0, None), (3, DAY, DAY, None, "x", 1.0, None)]
    assert found(spark, [one, one, *nulls]) == plain([one]) and plain([one])[0][7] == "end"
    late = [(4, DAY - dt.timedelta(hours=1), DAY + dt.timedelta(hours=1), 5, "click", 1.0, None), (6, DAY, DAY + dt.timedelta(hours=2), 5, None, None, None)]
    assert found(spark, [one, *late]) == plain([one, *late]) and plain([one, *late])[0][5] == 1
    assert found(spark, late) == []
    ties = [(i, DAY, None, 5, "purchase" if i % 2 else None, 60.0, None) for i in range(9)]
    assert found(spark, ties, block=2) == plain(ties)
    differ = [(1, DAY, None, 5, None, 2.0, None), (1, DAY, None, 5, "purchase", 70.0, None), (1, DAY + dt.timedelta(minutes=1), None, 4, None, 2.0, None)]
    assert found(spark, differ) == plain(differ)


def test_other_columns_and_zones(spark):
    rows = random_rows(9, 60, 2, 60)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS block", "1 AS part", "2 AS late", "3 AS final", "4 AS path")
    assert sorted(tuple(r[c] for c in COLUMNS) for r in S.sessions(df).collect()) == plain(rows)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # a clock change falls into these rows
        assert found(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sql(spark, tmp_path):
    rows = random_rows(11, 400, 3, 100, 0.03)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "clicks"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW clicks AS SELECT * FROM read_parquet('{tmp_path}/clicks/*.parquet')")
    got = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({S.ORACLE_SQL})").fetchall()
    assert sorted(got) == found(spark, rows, block=20) == plain(rows)


def test_sweep_and_marks():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50):
        ts = np.sort(rng.integers(0, 3 * S.LENGTH, n))
        hard = rng.random(n) < 0.1
        jump = S.jumps(ts, hard)
        for i, leave in enumerate(S.exits(jump).tolist()):
            at = i
            while jump[at] < n:
                at = jump[at]
            assert leave == at
        if n:
            at, seen = 0, {0}
            while jump[at] < n:
                at = int(jump[at])
                seen.add(at)
            assert set(np.flatnonzero(S.marked(jump, np.array([0])))) == seen
