"""Books by validity intervals against the sequential state."""

from __future__ import annotations

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.operators import book, rebuild, series

LEVELS = "array<struct<price:decimal(18,8),quantity:decimal(18,8)>>"
SCHEMA = f"capture_session_id string, symbol string, capture_seq bigint, kind string, first_id bigint, final_id bigint, previous_id bigint, bids {LEVELS}, asks {LEVELS}, snapshot_limit int, buffered_ids array<bigint>"


def model(rows):
    """{(symbol, capture_seq): (reason, id, bids, asks, gaps)} and the first fault of each generation, one event after the other."""
    out, faults = {}, []
    for symbol in sorted({r[1] for r in rows}):
        own, reason, bridge, gaps, recent, last = None, rebuild.NO_BOOK, None, 0, {}, None

        def fail(seq, why):
            nonlocal own, reason
            own, reason = None, why
            faults.append((symbol, seq, why))

        def apply(seq, e):
            nonlocal bridge, gaps, reason, last
            first, final, previous, bids, asks = e
            if own is None:
                return
            if bridge is not None:
                if final < bridge:
                    return
                if not first <= bridge <= final:
                    return fail(seq, rebuild.NO_BOOK)
            elif final == last:
                return
            elif previous != last:
                gaps += 1
                return fail(seq, rebuild.NO_BOOK)
            if any(p <= 0 or q < 0 for p, q in bids + asks):
                return fail(seq, "invalid depth: bad level")
            try:
                own.apply(final, bids, asks)
            except book.BookError as error:
                return fail(seq, f"invalid depth: {error}")
            bridge, reason, last = None, None, final

        for _, _, seq, kind, first, final, previous, bids, asks, limit, buffered in sorted((r for r in rows if r[1] == symbol), key=lambda r: r[2]):
            if kind == "lifecycle":
                own, reason, recent = None, rebuild.NO_BOOK, {}
            elif kind == "depth":
                recent[final] = (first, final, previous, bids or [], asks or [])
                apply(seq, recent[final])
            elif kind == "bootstrap":
                own, reason, bridge, last = book.Book(), "not bridged", final, None
                try:
                    own.load(final, bids or [], asks or [], limit)
                except book.BookError as error:
                    fail(seq, "invalid bootstrap: " + ("bad snapshot level" if str(error).startswith("bad") else str(error)))
                for i in buffered or []:
                    if own is not None and i not in recent:
                        fail(seq, f"missing buffered depth event {i}")
                    elif own is not None:
                        apply(seq, recent[i])
            else:
                n = max(len(bids or []), len(asks or []))
                top = own.top(n) if reason is None else (None, None)
                out[symbol, seq] = (reason, last if reason is None else None, *top, gaps)
    return out, sorted(faults)


def stream(rng, n):
    rows, ids = [], {}
    for seq in range(n):
        symbol = rng.choice("AAB")
        last, seen = ids.get(symbol, (10 * seq, []))
        kind = rng.choices(["depth", "trusted", "bootstrap", "lifecycle"], [60, 30, 3, 1])[0]
        if kind == "depth":
            final = last + rng.choice([1, 1, 3])
            level = lambda base, sign: [(D(base + sign * rng.randint(0, 14)), D(rng.choice([0, 0, 1, 2, 5]))) for _ in range(rng.choice([0, 1, 1, 2, 4]))]
            bids, asks = level(99, -1), level(100, 1)
            if rng.random() < 0.01:
                bids = bids + [(D(rng.choice([0, 104, 120])), D(1))]
            previous = last if rng.random() > 0.01 else last - 1
            rows.append(("S", symbol, seq, kind, last if rng.random() < 0.5 else last + 1, final, previous, bids, asks, None, None))
            if rng.random() < 0.05:
                continue
            ids[symbol] = (final, [*seen, final][-5:])
        elif kind == "bootstrap":
            size = rng.choice([2, 12, 15])
            bids, asks = ([(D(base + sign * i), D(1 + i % 3)) for i in range(size)] for base, sign in ((99, -1), (100, 1)))
            if rng.random() < 0.1:
                asks = rng.choice([asks + asks[:1], [(D(98), D(1))], []])
            buffered = rng.choice([[], [last], seen[-3:], [last + 77]])
            rows.append(("S", symbol, seq, kind, None, last, None, bids, asks, rng.choice([None, 12, 1000]), buffered))
        elif kind == "trusted":
            n = rng.choice([0, 1, 5, 30])
            rows.append(("S", symbol, seq, kind, None, last, None, [(D(1), D(1))] * n, None if n == 1 else [], None, None))
        else:
            rows.append(("S", symbol, seq, kind, *[None] * 7))
    return rows


@pytest.mark.parametrize(("seed", "chunk_rows"), [(1, 4), (2, 16), (3, 512)])
def test_equal_to_the_sequential_state(spark, seed, chunk_rows):
    rows = stream(random.Random(seed), 700)
    made = rebuild.rebuild(spark.createDataFrame(rows, SCHEMA), chunk_rows)
    pairs = lambda x: None if x is None else [tuple(e) for e in x]
    got = {(r.symbol, r.capture_seq): (r.reason, r.made_id, pairs(r.made_bids), pairs(r.made_asks), r.gaps) for r in made.books.collect()}
    wanted, faults = model(rows)
    assert got == wanted
    assert sum(r[0] is None for r in wanted.values()) > 20
    assert sorted((r.symbol, r.capture_seq, r.reason) for r in made.faults.collect()) == faults


def test_compared_books_are_rebuilt_once(spark, monkeypatch):
    from tidemark.plans import books

    calls, once = [], rebuild.rebuild
    monkeypatch.setattr(rebuild, "rebuild", lambda *a, **k: calls.append(a) or once(*a, **k))
    got = books.reconstruct_compare(spark, "/root/testdata/sf0.001").collect()
    assert len(calls) == 1 and got


def test_recorded_levels_do_not_move_the_rebuilt_books(spark):
    """Books recorded from the rebuilt ones, some altered, compared without and with a second rebuild."""
    events = spark.createDataFrame(stream(random.Random(5), 700), SCHEMA)
    made = rebuild.rebuild(events, 16).books.localCheckpoint()
    known = made.where("reason is null").select("symbol", "capture_seq", "made_id", F.col("made_bids").alias("b"), F.col("made_asks").alias("a"))
    odd = F.col("capture_seq") % 3 == 0
    altered = F.transform("b", lambda x: F.struct(x["price"].alias("price"), F.when(odd, x["quantity"] + 1).otherwise(x["quantity"]).cast("decimal(18,8)").alias("quantity")))
    rows = events.join(known, ["symbol", "capture_seq"], "left").withColumns({"bids": F.coalesce(altered, "bids"), "asks": F.coalesce("a", "asks"), "final_id": F.coalesce(F.col("made_id") - F.when(F.col("capture_seq") % 5 == 0, 1).otherwise(0), "final_id")})
    rows = rows.select(*events.columns).localCheckpoint()
    got = sorted(tuple(r) for r in book.compare(rows, made).collect())
    assert got == sorted(tuple(r) for r in book.reconstruct(rows, 16).collect())
    assert {r[3] for r in got} == {True, False}


def test_one_generation_is_many_tasks(spark):
    bids, asks = ([(D(base + sign * i), D(1)) for i in range(40)] for base, sign in ((99, -1), (100, 1)))
    rows = [("S", "A", 0, "bootstrap", None, 0, None, bids, asks, 1000, [])]
    rows += [("S", "A", i, "depth", i - 1, i, i - 1, [(D(99 - i % 7), D(i % 3))], [], None, None) for i in range(1, 3000)]
    rows += [("S", "A", 3000, "trusted", None, 2999, None, bids[:3], asks[:3], None, None)]
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = rebuild.chain(rebuild._marked(spark.createDataFrame(rows, SCHEMA)))
        states = rebuild.tops(found, 64).withColumn("task", F.spark_partition_id())
        tasks = states.groupBy("task").agg(F.count("made_bids").alias("n"), F.sum("bids_in")).collect()
        assert len(tasks) >= 8 and sum(t.n for t in tasks) == 3000
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_faults_without_a_recorded_book(spark):
    level = [(D(100), D(1))], [(D(102), D(1))]
    rows = [("S", "A", 1, "bootstrap", None, 5, None, *level, 1000, [4]), ("S", "A", 2, "bootstrap", None, 9, None, level[1], level[0], 1000, []), ("S", "A", 3, "trusted", None, 9, None, *level, None, None)]
    faults = {r.capture_seq: (r.reason, r.fatal) for r in book.reconstruction_faults(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert faults == {1: ("missing buffered depth event 4", True), 2: ("invalid bootstrap: crossed", True)}


def test_last_before(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), i, rng.choice([None, None, rng.randint(0, 9)])) for i in range(200)]
    got = series.last_before(spark.createDataFrame(rows, "k string, o long, v long"), F.col("v"), "p", ["k"], "o", 16).collect()
    last, wanted = {}, {}
    for k, o, v in rows:
        wanted[o] = last.get(k)
        last[k] = v if v is not None else last.get(k)
    assert {r.o: r.p for r in got} == wanted
