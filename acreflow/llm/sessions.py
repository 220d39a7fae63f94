"""Gap sessionisation by square-root decomposition.

The timely clicks of all clients, in the order of client, time and id, are cut into blocks of about equal size: the ranges
of a range partitioning, so one client with most of the clicks has many blocks.  Within a block a click's *jump* is where
the next session begins if one begins at it; a sweep from the end gives each click its *exit*, the last session start
that is reached from it without leaving the block.

What a session start depends on stops at a click that ends a session whatever came before (its predecessor was final
or a gap lies between).  Behind the first such click a block needs nothing from outside: its sessions are worked off at once,
and its last open session is its summary.  The clicks before it, the block's head, wait for the state that the blocks before
leave: summaries are hopped from block to block, a few numbers each, and the starts that an entry reaches are then marked
within heads.  A block that is all head (one client, no such click) passes on what its exits say.

Fragments of sessions that cross a block's edge are added up at the end.  No step gathers a client's clicks: tasks hold
one block, and only the path of a single session (at most ``LENGTH`` long) is brought together, as its digest asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreflow.plans.storage import stored

MINUTE = 60_000_000
#: A gap ends a session, a session is at most so long, a click that arrives later is late.
GAP, LENGTH, LATE = 5 * MINUTE, 120 * MINUTE, 60 * MINUTE
FINAL_KIND, FINAL_VALUE = "purchase", 60
#: Clicks in a block.
BLOCK = 1 << 17

_REASONS = ("end", "gap", "length")
_CELLS = "client_id long, start_us long, session_id long, end_us long, n_clicks long, n_late long, value_cents long, final boolean, closed_by string, path_sha256 string, path string, block long"
#: 0: a whole session; 1: a fragment of one; 2: a click of a head; 3: a block's summary.
_OUT = f"part int, {_CELLS}, late boolean, cents long, exit_us long, exit_id long, next_reason string, fixed boolean, timely boolean, first_client long"
_FIELDS = [(f.split()[0], f.split()[1]) for f in _OUT.split(", ")]
_ARROW = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def microseconds(column: Column, kind: str) -> Column:
    """Microseconds since 1970 (UTC) of a timestamp, with or without a zone; none depends on the session's zone."""
    if kind == "timestamp":
        return F.unix_micros(column)
    since = column - F.lit("1970-01-01").cast("timestamp_ntz")
    part = lambda p: F.date_part(F.lit(p), since)
    seconds = (part("DAY").cast("long") * 24 + part("HOUR").cast("long")) * 3600 + part("MINUTE").cast("long") * 60
    return seconds * 1_000_000 + (part("SECOND") * 1_000_000).cast("long")


def numbers(clicks: DataFrame) -> DataFrame:
    """(click_id, client_id, ts, late, final, cents), once per click_id, of ``clicks``.

    Rows without click_id, client_id or ts are left out.  Of rows that share a click_id but differ, the one with the smallest
    (ts, client_id, late, final, cents) counts.  A click that has no arrived_at is not late.
    """
    kinds = dict(clicks.dtypes)
    ts, arrived = (microseconds(F.col(c), kinds[c]) for c in ("ts", "arrived_at"))
    rows = clicks.filter("click_id is not null and client_id is not null and ts is not null").select(
        F.col("click_id").cast("long").alias("click_id"), ts.alias("ts"), F.col("client_id").cast("long").alias("client_id"), F.coalesce(arrived - ts > LATE, F.lit(False)).alias("late"),
        F.coalesce((F.col("value") >= FINAL_VALUE) & (F.col("kind") == FINAL_KIND), F.lit(False)).alias("final"), F.coalesce(F.floor(F.col("value").cast("double") * 100 + 0.5), F.lit(0)).cast("long").alias("cents"),
    )
    once = rows.groupBy("click_id").agg(F.min(F.struct("ts", "client_id", "late", "final", "cents")).alias("c"))
    return once.select("click_id", "c.client_id", "c.ts", "c.late", "c.final", "c.cents")


def jumps(ts: np.ndarray, hard: np.ndarray) -> np.ndarray:
    """For each timely click of a block the one that begins the next session if it begins one; the block's size if none here does."""
    n = len(ts)
    by_length = np.searchsorted(ts, ts + LENGTH, "right")
    breaks = np.append(np.flatnonzero(hard), n)
    return np.minimum(by_length, breaks[np.searchsorted(breaks, np.arange(n), "right")])


def exits(jump: np.ndarray) -> np.ndarray:
    """The last start within the block that is reached from each click, by a sweep from the end."""
    out, n = jump.tolist(), len(jump)
    for i in range(n - 1, -1, -1):
        j = out[i]
        out[i] = i if j >= n else out[j]
    return np.array(out, np.int64)


def marked(jump: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which clicks begin a session, if those of ``entries`` do."""
    out = np.zeros(len(jump), bool)
    at = entries
    while len(at):
        out[at] = True
        at = jump[at]
        at = at[at < len(jump)]
        at = at[~out[at]]
    return out


class _Client:
    """The rows of one client in a block, in order: clicks in time and late ones, which belong to the session before them."""

    def __init__(self, client: int, rows: dict[str, np.ndarray], a: int, b: int) -> None:
        cut = {k: v[a:b] for k, v in rows.items()}
        self.client, self.rows, self.late = client, cut, cut["late"]
        self.at = np.flatnonzero(~self.late)
        self.ts, self.ids, self.final, self.cents = (cut[k][self.at] for k in ("ts", "click_id", "final", "cents"))
        n = len(self.at)
        self.end_before, self.gap_before = np.zeros(n, bool), np.zeros(n, bool)
        self.end_before[1:] = self.final[:-1]
        self.gap_before[1:] = np.diff(self.ts) >= GAP
        self.hard = self.end_before | self.gap_before

    def reason(self, i: int) -> str:
        """Why the click at ``i`` begins a session, known to be one."""
        return "end" if self.end_before[i] else "gap" if self.gap_before[i] else "length"

    def sessions(self, starts: np.ndarray) -> Iterator[tuple[int, int, dict]]:
        """(from, to, cells) for the sessions that begin at ``starts``; late clicks belong to the one before them."""
        n, total = len(self.at), np.append(0, np.cumsum(self.cents))
        place = np.append(self.at, len(self.late))
        late = np.append(0, np.cumsum(self.late))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
            yield a, b, {
                "client_id": self.client, "start_us": int(self.ts[a]), "session_id": int(self.ids[a]), "end_us": int(self.ts[b - 1]), "n_clicks": b - a,
                "n_late": int(late[place[b]] - late[place[a]]), "value_cents": int(total[b] - total[a]), "final": bool(self.final[b - 1]), "path": ",".join(map(str, self.ids[a:b].tolist())),
            }


def work_off(block: int, rows: dict[str, np.ndarray]) -> list[dict]:
    """All that a block can say: whole sessions, the open one, its head with exits, and its summary."""
    out: list[dict] = []
    client = rows["client_id"]
    edges = np.flatnonzero(np.concatenate(([True], client[1:] != client[:-1], [True])))
    summary = {"part": 3, "block": block, "client_id": int(client[-1]), "fixed": len(edges) > 2, "timely": False, "first_client": int(client[0])}
    for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        own, leads, last = _Client(int(client[a]), rows, a, b), k == 0, k == len(edges) - 2
        n, begin = len(own.at), 0
        if leads:  # the head: up to the first click that begins a session whatever came before
            begin = int(np.flatnonzero(own.hard)[0]) if own.hard.any() else n
            stop = int(own.at[begin]) if begin < n else b - a
            jump = jumps(own.ts[:begin], own.hard[:begin])
            leave, t = exits(jump), 0
            for i in range(stop):
                late = bool(own.late[i])
                row = {"part": 2, "block": block, "client_id": own.client, "late": late, "start_us": int(own.rows["ts"][i]), "session_id": int(own.rows["click_id"][i]), "final": bool(own.rows["final"][i]), "cents": int(own.rows["cents"][i])}
                if not late:
                    row |= {"exit_us": int(own.ts[leave[t]]), "exit_id": int(own.ids[leave[t]])}
                    t += 1
                out.append(row | {"next_reason": own.reason(begin) if begin < n else None})
        if begin < n:
            hard = own.hard[begin:].copy()
            hard[0] = True
            starts = begin + np.flatnonzero(marked(jumps(own.ts[begin:], hard), np.flatnonzero(hard)))
            for i, j, cells in own.sessions(starts):
                if j < n or not last:
                    cells["path_sha256"] = hashlib.sha256(cells.pop("path").encode()).hexdigest()
                    cells["closed_by"] = own.reason(j) if j < n else "end" if cells["final"] else "none"
                    out.append({"part": 0} | cells)
                else:
                    out.append({"part": 1, "block": block} | cells)
                    summary |= {"start_us": cells["start_us"], "session_id": cells["session_id"], "fixed": True}
        if last and n:
            summary |= {"end_us": int(own.ts[-1]), "final": bool(own.final[-1]), "timely": True}
    return [*out, summary]


def _table(rows: list[dict], fields: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], _ARROW[t]) for n, t in fields], [n for n, _ in fields])


_NUMBERS = ("client_id", "ts", "click_id", "cents")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        rows = {c: table.column(c).to_numpy() for c in _NUMBERS} | {c: table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("late", "final")}
        out = work_off(int(table.column("block")[0].as_py()), rows)
        for at in range(0, len(out), 1 << 14):
            yield _table(out[at : at + (1 << 14)], _FIELDS)


#: The state in which a block leaves its last client: the last timely click and the start of the open session.
_STATE = ("client_id", "end_us", "final", "start_us", "session_id")


def hop(summaries: DataFrame, heads: DataFrame) -> DataFrame:
    """(at, in_client_id, in_end_us, in_final, in_start_us, in_session_id): the state that each block begins with, where its first
    client has one.  Blocks that determine their own end are known at once; each round then carries states through one more of the
    blocks that are all head, of which only clicks that an entry reaches are looked at."""
    cells = summaries.select("block", *_STATE, "fixed", "timely", "first_client")
    known = cells.filter("fixed").select("block", *_STATE)
    todo, n = cells.filter("not fixed"), 0
    waiting = todo.count()
    while waiting:
        entry = known.select((F.col("block") + 1).alias("block"), *(F.col(c).alias(f"in_{c}") for c in _STATE))
        ready = todo.join(entry, "block", "left").filter("in_client_id is not null or block = 0")
        same = F.col("in_client_id") == F.col("first_client")
        ready = ready.select("block", "client_id", "timely", F.col("end_us").alias("own_end"), F.col("final").alias("own_final"), *(F.when(same, F.col(f"in_{c}")).alias(f"in_{c}") for c in _STATE[1:]))
        lead = heads.filter("not late").groupBy("block").agg(F.min(F.struct("start_us", "session_id")).alias("lead"))
        met = heads.filter("not late").join(ready, ["block", "client_id"]).join(lead, "block")
        first = F.struct("start_us", "session_id") == F.col("lead")
        breaks = F.col("in_start_us").isNull() | (first & (F.col("in_final") | (F.col("start_us") - F.col("in_end_us") >= GAP))) | (F.col("start_us") - F.col("in_start_us") > LENGTH)
        landed = met.filter(breaks).groupBy("block").agg(F.min(F.struct("start_us", "session_id", "exit_us", "exit_id")).alias("at"))
        moved = ready.join(landed, "block", "left").select(
            "block", "client_id", F.when(F.col("timely"), F.col("own_end")).otherwise(F.col("in_end_us")).alias("end_us"), F.when(F.col("timely"), F.col("own_final")).otherwise(F.col("in_final")).alias("final"),
            F.coalesce("at.exit_us", "in_start_us").alias("start_us"), F.coalesce("at.exit_id", "in_session_id").alias("session_id"),
        )
        known = stored(known.unionByName(moved), f"states{n}")
        todo = cells.filter("not fixed").join(known.select("block"), "block", "left_anti")
        left, n = todo.count(), n + 1
        if left == waiting:
            raise RuntimeError("blocks are not numbered without holes")
        waiting = left
    entry = known.select((F.col("block") + 1).alias("block"), *_STATE).filter("start_us is not null")
    return entry.join(cells.select("block", F.col("first_client").alias("client_id")).hint("merge"), ["block", "client_id"]).select(F.col("block").alias("at"), *(F.col(c).alias(f"in_{c}") for c in _STATE))


_FRAGMENT = [f for f in _FIELDS if f[0] in {c.split()[0] for c in _CELLS.split(", ")} - {"path_sha256"}]


def _expanded(key: tuple, head: pa.Table, entry: pa.Table) -> pa.Table:
    """The fragments of sessions that a block's head holds, given the state it begins with; one of no clicks closes a session or counts late clicks."""
    out: list[dict] = []
    block, state = key[0].as_py(), entry.to_pylist()[0] if entry.num_rows else None
    if head.num_rows:
        order = np.lexsort([head.column(c).to_numpy() for c in ("session_id",)] + [head.column("late").to_numpy(zero_copy_only=False), head.column("start_us").to_numpy()])
        head = head.take(pa.array(order))
        rows = {"ts": head.column("start_us").to_numpy(), "click_id": head.column("session_id").to_numpy(), "cents": head.column("cents").to_numpy()}
        rows |= {c: head.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("late", "final")}
        own = _Client(head.column("client_id")[0].as_py(), rows, 0, head.num_rows)
        n, next_reason, begin = len(own.at), head.column("next_reason")[0].as_py(), 0
        if state and n:  # how far the session that is open goes on
            own.end_before[0], own.gap_before[0] = state["in_final"], own.ts[0] - state["in_end_us"] >= GAP
            begin = 0 if own.end_before[0] or own.gap_before[0] else int(np.searchsorted(own.ts, state["in_start_us"] + LENGTH, "right"))
        stop = int(own.at[begin]) if begin < n else head.num_rows
        if state:
            closed = own.reason(begin) if begin < n else next_reason
            path = ",".join(map(str, own.ids[:begin].tolist()))
            out.append({
                "client_id": own.client, "start_us": state["in_start_us"], "session_id": state["in_session_id"], "end_us": int(own.ts[begin - 1]) if begin else state["in_end_us"], "n_clicks": begin, "n_late": int(own.late[:stop].sum()),
                "value_cents": int(own.cents[:begin].sum()), "final": bool(own.final[begin - 1]) if begin else state["in_final"], "closed_by": closed, "path": path, "block": block,
            })
        if begin < n:
            hard = np.zeros(n - begin, bool)
            hard[0] = True
            starts = begin + np.flatnonzero(marked(jumps(own.ts[begin:], hard), np.zeros(1, np.int64)))
            for _, j, cells in own.sessions(starts):
                out.append(cells | {"closed_by": "length" if j < n else next_reason, "block": block})
    return pa.Table.from_batches([_table(out, _FRAGMENT)])


def sessions(clicks: DataFrame, block: int = BLOCK) -> DataFrame:
    """Sessions of ``clicks`` (click_id, ts, arrived_at, client_id, kind, value, more), one row each.

    client_id, session_id (the first click's), start_us, end_us, n_clicks, n_late, value_cents, closed_by, path_sha256.  A
    client's timely clicks in the order of ts and click_id continue the session unless the one before is final (``end``) or
    ``GAP`` earlier (``gap``), or the session's first is over ``LENGTH`` earlier (``length``); closed_by is the first of these that
    the next timely click meets, without one ``end`` if the last is final, else ``none``.  Late clicks count in the last
    session that begins at or before them; those before a client's first session in none.  Which rows count is said by
    ``numbers``; null, empty or other kinds and null values are never final and worth 0.  An empty table gives none; other
    columns are ignored.  ``block``: clicks in a block, which steers memory and not the result.
    """
    spark = clicks.sparkSession
    size = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-clicks.count() // block))
    order = ("client_id", "ts", "late", "click_id")
    ranged = numbers(clicks).repartitionByRange(size, *order).sortWithinPartitions(*order).withColumn("block", F.spark_partition_id().cast("long"))
    out = stored(ranged.mapInArrow(_blocks, _OUT), "blocks")
    heads, summaries = out.filter("part = 2"), out.filter("part = 3")
    entries = hop(summaries, heads)
    head = heads.select("block", "client_id", "late", "start_us", "session_id", "final", "cents", "next_reason")
    names = [n for n, _ in _FRAGMENT]
    schema = ", ".join(f"{n} {t}" for n, t in _FRAGMENT)
    pieces = head.groupBy("block").cogroup(entries.groupBy("at")).applyInArrow(_expanded, schema)
    # A session that ends with its block goes on in the next one's head, or not at all: then nothing says why it was closed.
    pieces = pieces.unionByName(out.filter("part = 1").select(*names))
    last = F.max(F.struct("end_us", "block", "final")).alias("last")
    path = F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("block", "path"))), lambda x: x["path"] != ""), lambda x: x["path"]), ",")
    whole = pieces.groupBy("client_id", "start_us", "session_id").agg(last, F.sum("n_clicks").alias("n_clicks"), F.sum("n_late").alias("n_late"), F.sum("value_cents").alias("value_cents"), F.max("closed_by").alias("closed_by"), path.alias("path"))
    columns = ("client_id", "session_id", "start_us", "end_us", "n_clicks", "n_late", "value_cents", "closed_by", "path_sha256")
    closed = F.coalesce("closed_by", F.when(F.col("last.final"), "end").otherwise("none"))
    merged = whole.withColumns({"end_us": F.col("last.end_us"), "closed_by": closed, "path_sha256": F.sha2(F.col("path").cast("binary"), 256)})
    return out.filter("part = 0").select(*columns).unionByName(merged.select(*columns))


#: The same by DuckDB.
ORACLE_SQL = f"""
WITH RECURSIVE numbered AS (
  SELECT click_id, min(struct_pack(ts := epoch_us(ts), client_id := client_id, late := coalesce(epoch_us(arrived_at) - epoch_us(ts) > {LATE}, false),
                  final := coalesce(value >= {FINAL_VALUE} AND kind = '{FINAL_KIND}', false), cents := coalesce(CAST(floor(100 * value + 0.5e0) AS BIGINT), 0))) AS c
  FROM clicks WHERE click_id IS NOT NULL AND client_id IS NOT NULL AND ts IS NOT NULL GROUP BY click_id
),
once AS (SELECT click_id, c.ts AS ts, c.client_id AS client_id, c.late AS late, c.final AS final, c.cents AS cents FROM numbered),
ordered AS (
  SELECT *, row_number() OVER w AS r, coalesce(lag(final) OVER w, true) AS end_before, ts - lag(ts) OVER w >= {GAP} AS gap_before
  FROM once WHERE NOT late WINDOW w AS (PARTITION BY client_id ORDER BY ts, click_id)
),
parts AS MATERIALIZED (SELECT *, sum(CASE WHEN end_before OR gap_before THEN 1 ELSE 0 END) OVER (PARTITION BY client_id ORDER BY r) AS part FROM ordered),
spots AS (SELECT client_id, part, ts, min(r) AS r FROM parts GROUP BY ALL),
after AS MATERIALIZED (SELECT p.client_id, p.part, p.r, n.r AS next_r FROM parts p ASOF LEFT JOIN spots n ON p.client_id = n.client_id AND p.part = n.part AND p.ts + {LENGTH} < n.ts),
starts AS (
  SELECT client_id, part, min(r) AS r FROM parts GROUP BY client_id, part
  UNION ALL
  SELECT s.client_id, s.part, a.next_r FROM starts s JOIN after a ON a.client_id = s.client_id AND a.r = s.r WHERE a.next_r IS NOT NULL
),
owned AS (SELECT p.*, max(s.r) OVER (PARTITION BY p.client_id ORDER BY p.r) AS first_r FROM parts p LEFT JOIN starts s ON s.client_id = p.client_id AND s.r = p.r),
reasons AS (SELECT *, lead(CASE WHEN r = first_r THEN CASE WHEN end_before THEN 'end' WHEN gap_before THEN 'gap' ELSE 'length' END END) OVER (PARTITION BY client_id ORDER BY r) AS why FROM owned),
whole AS (
  SELECT client_id, arg_min(click_id, r) AS session_id, min(ts) AS start_us, max(ts) AS end_us, count(*) AS n_clicks, CAST(sum(cents) AS BIGINT) AS value_cents,
         coalesce(max(why), CASE WHEN arg_max(final, r) THEN 'end' ELSE 'none' END) AS closed_by, sha256(string_agg(CAST(click_id AS VARCHAR), ',' ORDER BY r)) AS path_sha256, first_r
  FROM reasons GROUP BY client_id, first_r
),
lasts AS (SELECT client_id, start_us, max(first_r) AS first_r FROM whole GROUP BY ALL),
tardy AS (SELECT o.client_id, l.first_r, count(*) AS n_late FROM (SELECT * FROM once WHERE late) o ASOF JOIN lasts l ON o.client_id = l.client_id AND o.ts >= l.start_us GROUP BY ALL)
SELECT w.client_id, session_id, start_us, end_us, n_clicks, coalesce(n_late, 0) AS n_late, value_cents, closed_by, path_sha256
FROM whole w LEFT JOIN tardy t ON t.client_id = w.client_id AND t.first_r = w.first_r
"""
