"""Synchronisation and deduplication as streams, cut in micro-batches, against one pass."""

from __future__ import annotations

import random
from decimal import Decimal as D

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.streaming import counts, keyed, sync

LEVELS = "array<struct<price:decimal(18,8),quantity:decimal(18,8)>>"
SCHEMA = f"symbol string, capture_seq bigint, monotonic_ns bigint, kind string, first_id bigint, final_id bigint, previous_id bigint, bids {LEVELS}, asks {LEVELS}, snapshot_limit int"
MS = 1_000_000


class Ring:
    """What `keyed.Recent` is, in memory."""

    def __init__(self, capacity=4096):
        self.capacity, self.ids = capacity, {}

    def __contains__(self, key):
        return key in self.ids

    def add(self, key):
        if key not in self.ids and len(self.ids) == self.capacity:
            self.ids.pop(next(iter(self.ids)))
        self.ids.setdefault(key)

    def clear(self):
        self.ids.clear()


def levels(*pairs):
    return [{"price": p, "quantity": q} for p, q in pairs]


def told(events, **options):
    """(state, wants_snapshot, counters that aren't zero) after each of ``events`` (kind, ns, fields)."""
    m = sync.Machine(Ring(), **options)
    base = dict(first_id=None, final_id=None, previous_id=None, bids=None, asks=None, snapshot_limit=None)
    pdf = pd.DataFrame([{"capture_seq": i, "monotonic_ns": ns, "kind": kind, **base, **own} for i, (kind, ns, own) in enumerate(events)])
    names = [c.split()[0] for c in sync.OUTPUT.split(", ")]
    rows = [dict(zip(names, r, strict=True)) for r in sync.run_rows(m, "A", pdf)]
    return [(r["state"], r["wants_snapshot"], {c: r[c] for c in sync.COUNTERS if r[c]}) for r in rows], rows


def depth(first, final, previous, bids=(), asks=(), ns=0):
    return ("depth", ns, dict(first_id=first, final_id=final, previous_id=previous, bids=levels(*bids), asks=levels(*asks)))


def snapshot(i, bids=((100, 1),), asks=((102, 1),), ns=0, limit=1000):
    return ("snapshot", ns, dict(final_id=i, bids=levels(*bids), asks=levels(*asks), snapshot_limit=limit))


UP = ("connected", 0, {})


def test_old_updates_go_and_the_bridge_is_played():
    got, rows = told([UP, depth(90, 95, 89), depth(96, 101, 95, [(100, 2)]), depth(102, 103, 101, [(99, 1)]), snapshot(100)])
    assert [g[0] for g in got] == ["BUFFERING"] * 4 + ["SYNCED"] and got[0][1]
    assert got[-1][2] == {"synced": 1, "applied": 2, "discarded": 1} and (rows[-1]["last_update_id"], rows[-1]["best_bid"], rows[-1]["buffered"]) == (103, 100, 0)


@pytest.mark.parametrize(("first", "final", "state"), [(100, 100, "SYNCED"), (99, 100, "SYNCED"), (100, 101, "SYNCED"), (101, 102, "RESYNCING")])
def test_bridge_without_plus_one(first, final, state):
    assert told([UP, depth(first, final, first - 1), snapshot(100)])[0][-1][0] == state


def test_missing_bridge_asks_again_and_keeps_what_waits():
    got, rows = told([UP, depth(105, 106, 104), snapshot(100), snapshot(105)])
    assert [(g[0], g[1]) for g in got[2:]] == [("RESYNCING", True), ("SYNCED", False)] and rows[2]["buffered"] == 1 and got[-1][2]["failures"] == 1


def test_gap_duplicate_conflict_and_stale_update():
    start = [UP, depth(96, 101, 95), snapshot(100), depth(102, 103, 101, [(99, 4)])]
    assert told([*start, depth(110, 111, 109)])[0][-1] == ("RESYNCING", True, {"resyncs": 1, "synced": 1, "failures": 1, "gaps": 1, "applied": 2})
    assert told([*start, depth(102, 103, 101, [(99, 4)])])[0][-1] == ("SYNCED", False, {"synced": 1, "applied": 2, "discarded": 1})
    conflict = told([*start, depth(102, 103, 101, [(99, 5)])])
    assert conflict[0][-1][0] == "RESYNCING" and conflict[1][-1]["reason"] == "update 103 after 103" and conflict[1][-1]["buffered"] == 1


def test_crossed_empty_and_invalid_snapshot():
    start = [UP, depth(96, 101, 95), snapshot(100)]
    crossed = told([*start, depth(102, 103, 101, [(102, 1)])])[0][-1]
    assert crossed[0] == "RESYNCING" and crossed[2]["crossed"] == 1
    assert told([*start, depth(102, 103, 101, [(100, 0)])])[1][-1]["reason"] == "empty side"
    again = told([UP, depth(96, 101, 95), snapshot(100, asks=((99, 1),)), ("snapshot_failed", 0, {}), snapshot(100)])[0]
    assert [(g[0], g[1]) for g in again[2:]] == [("RESYNCING", True), ("RESYNCING", True), ("SYNCED", False)] and again[-1][2]["failures"] == 2


def test_overflow_reconnect_and_staleness():
    got, rows = told([UP, *[depth(i, i, i - 1) for i in range(1, 5)]], max_buffered=3)
    assert got[-1] == ("RESYNCING", True, {"resyncs": 1, "failures": 1, "overflows": 1}) and rows[-1]["buffered"] == 1
    start = [UP, depth(96, 101, 95, ns=5), snapshot(100, ns=6)]
    assert [g[0] for g in told([*start, ("disconnected", 7, {}), depth(102, 103, 101), ("connected", 8, {})])[0][3:]] == ["DESYNCED", "DESYNCED", "RESYNCING"]
    stale, rows = told([*start, depth(102, 103, 101, ns=3006 * MS), depth(104, 105, 103, ns=3007 * MS)])
    assert [g[0] for g in stale[3:]] == ["STALE", "SYNCED", "SYNCED"] and rows[3]["monotonic_ns"] == 5 + 3000 * MS and rows[3]["best_bid"] is None


def stream_rows(rng, n):
    rows, ids, t = [], {}, 0
    for seq in range(n):
        symbol = rng.choice("AB")
        t += rng.choice([1, 20, 100]) * MS + (4000 * MS if rng.random() < 0.02 else 0)
        last = ids.get(symbol, 100)
        kind = rng.choices(["depth", "snapshot", "connected", "disconnected", "snapshot_failed"], [70, 14, 2, 1, 1])[0] if symbol in ids else "connected"
        ids.setdefault(symbol, last)
        base = [None] * 5
        if kind == "depth":
            final = last + 1
            bids = [(D(99 - rng.randint(0, 5)), D(rng.choice([0, 1, 3])))]
            base = [last + 1, final, last if rng.random() > 0.04 else last - 1, bids, [(D(rng.choice([104, 105, 106] + [97] * (rng.random() < 0.05))), D(1))]]
            ids[symbol] = final
            rows.append((symbol, seq, t, kind, *base, None))
            if rng.random() < 0.05:
                rows.append((symbol, seq, t, kind, *base, None))
            continue
        if kind == "snapshot":
            base = [None, last - rng.choice([0, 0, 1, 3]), None, [(D(99 - i), D(1)) for i in range(12)], [(D(104 + i), D(1)) for i in range(12)]]
        rows.append((symbol, seq, t, kind, *base, 12 if kind == "snapshot" else None))
    return [(r[0], i, *r[2:]) for i, r in enumerate(rows)]


def test_stream_in_batches_equals_one_pass(spark, tmp_path):
    rows = stream_rows(random.Random(11), 500)
    frame = spark.createDataFrame(rows, SCHEMA)
    cuts = [0, 3, 90, 200, 201, 380, 500]
    for i, (lo, hi) in enumerate(zip(cuts, [*cuts[1:], 10_000])):
        frame.where((F.col("capture_seq") >= lo) & (F.col("capture_seq") < hi)).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
    stream = counts.stream_of(spark, str(tmp_path / "in" / "*"), frame.schema)
    counts.drain(sync.synchronise(stream, max_buffered=15), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted((tuple(None if v != v else v for v in r) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)
    wanted = []
    pdf = frame.withColumns({c: keyed.long_levels(c) for c in ("bids", "asks")}).toPandas()
    for symbol, own in pdf.groupby("symbol"):
        m = sync.Machine(Ring(), max_buffered=15)
        wanted += sync.run_rows(m, symbol, own)
        due = m.stale_at()
        if due is not None and due // MS + 1 <= pdf["monotonic_ns"].max() // MS:
            wanted.append(sync._stale(m, symbol, due))
    states = {w[3] for w in wanted}
    assert states >= {"SYNCED", "STALE", "RESYNCING", "BUFFERING", "SYNCING"} and max(w[14] for w in wanted) > 0
    assert got == sorted((tuple(w) for w in wanted), key=str)


def test_bounded_deduplication(spark, tmp_path):
    rng, rows = random.Random(2), []
    for i in range(300):
        rows.append((rng.choice("ab"), i, rng.choice([None, *range(12)])))
    frame = spark.createDataFrame(rows, "symbol string, capture_seq bigint, trade_id bigint")
    for i in range(4):
        frame.where(F.expr(f"capture_seq div 75 = {i}")).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    stream = counts.stream_of(spark, str(tmp_path / "in" / "*"), frame.schema)
    counts.drain(keyed.first_of_recent(stream, "symbol", "trade_id", capacity=6), str(tmp_path / "out"), str(tmp_path / "cp"))
    rings, wanted = {}, []
    for symbol, seq, i in rows:
        ring = rings.setdefault(symbol, Ring(6))
        if i not in ring:
            wanted.append(seq)
        ring.add(i)
    assert sorted(r.capture_seq for r in spark.read.parquet(str(tmp_path / "out")).collect()) == wanted
    assert 20 < len(wanted) < 290
