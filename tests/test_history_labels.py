"""Known answers and row-at-a-time models of the time-series operators."""

from __future__ import annotations

import bisect
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import clock, history, labels, series, signals, stats

S = 1_000_000_000
SCHEMA = "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint, price decimal(18,8), feature_valid boolean, x double"


def frame(spark, rows):
    """rows: (seconds, price[, valid[, x]])."""
    from decimal import Decimal

    out = [("S", "A", i, round(r[0] * S), Decimal(str(r[1])), r[2] if len(r) > 2 else True, float(r[3]) if len(r) > 3 else 0.0) for i, r in enumerate(rows)]
    return spark.createDataFrame(out, SCHEMA)


def by_seq(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("capture_seq").collect()]


def test_forward_return_and_tail(spark):
    got = by_seq(labels.forward_labels(frame(spark, [(0, 100), (0.4, 104), (0.6, 106)]), horizons={"250ms": S // 4, "500ms": S // 2}, excursions=()), "future_return_250ms", "future_return_500ms")
    assert got[0] == (pytest.approx(math.log(1.04)), pytest.approx(math.log(1.06)))
    assert got[2] == (None, None)


def test_excursions(spark):
    got = by_seq(labels.forward_labels(frame(spark, [(0, 100), (0.4, 102), (0.7, 99), (1.0, 101)]), horizons={"1s": S}, excursions=("1s",)), "future_max_up_bps_1s", "future_max_down_bps_1s")
    assert got[0] == (pytest.approx(math.log(1.02) * 1e4), pytest.approx(math.log(0.99) * 1e4))


def test_gap_invalid_tick_and_boundary_void_labels(spark):
    assert by_seq(labels.forward_labels(frame(spark, [(0, 100), (10, 101)]), horizons={"250ms": S // 4}, excursions=()), "future_return_250ms") == [(None,), (None,)]
    rows = [(0, 100), (0.5, 101, False), (1.0, 102), (1.5, 103), (2.0, 104)]
    got = by_seq(labels.forward_labels(frame(spark, rows), horizons={"1s": S}, excursions=()), "future_return_1s")
    assert got[0] == (None,) and got[1] == (None,) and got[2][0] == pytest.approx(math.log(104 / 102))
    bound = spark.createDataFrame([("S", "A", round(0.55 * S))], "capture_session_id string, symbol string, monotonic_ns bigint")
    got = by_seq(labels.forward_labels(frame(spark, [(i / 10, 100 + i) for i in range(20)]), bound, {"1s": S, "250ms": S // 4}, ()), "future_return_1s", "future_return_250ms")
    assert got[0][0] is None and got[0][1] is not None and got[6][0] is not None


def test_labels_agree_with_a_model_across_chunks(spark, monkeypatch):
    rng = random.Random(4)
    t, rows = 0.0, []
    for _ in range(300):
        t += rng.choice([0.1, 0.2, 0.5, 0.9, 3.5])
        rows.append((round(t, 1), 100 + rng.random(), rng.random() > 0.05))
    df = frame(spark, rows)
    whole = by_seq(labels.forward_labels(df, horizons={"1s": S}, excursions=()), "future_return_1s")
    ns = [round(r[0] * S) for r in rows]
    price = [float(p) for (p,) in by_seq(df, "price")]
    want = []
    for i in range(len(rows)):
        j = bisect.bisect_left(ns, ns[i] + S, lo=i + 1)
        ok = j < len(ns) and all(rows[k][2] and (k == 0 or ns[k] - ns[k - 1] <= 3 * S) for k in range(i, j + 1))
        want.append(math.log(price[j] / price[i]) if ok else None)
    assert [x for (x,) in whole] == [None if w is None else pytest.approx(w) for w in want]
    monkeypatch.setattr(series.chunked, "__defaults__", ("monotonic_ns", 20 * S))
    assert by_seq(labels.forward_labels(df, horizons={"1s": S}, excursions=()), "future_return_1s") == whole


def test_backward_return_retention_and_volatility(spark):
    got = by_seq(history.backward_returns(frame(spark, [(0, 100), (0.2, 105), (1.1, 110)]), {"1s": S}), "return_1s")
    assert got == [(None,), (None,), (pytest.approx(math.log(1.1)),)]
    assert by_seq(history.backward_returns(frame(spark, [(0, 100), (20, 110)]), {"10s": 10 * S}), "return_10s")[1] == (None,)
    got = by_seq(history.realized_volatility(frame(spark, [(0, 100), (0.5, 110), (1, 99)]), {"1s": S}), "realized_volatility_1s")
    assert got[0] == (None,) and got[2][0] == pytest.approx(math.sqrt(math.log(1.1) ** 2 + math.log(0.9) ** 2))
    assert by_seq(history.realized_volatility(frame(spark, [(0, 100), (0.5, 100)]), {"1s": S}), "realized_volatility_1s")[1] == (0.0,)


def test_trade_flow_edges_and_peers(spark):
    from decimal import Decimal

    schema = "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint, price decimal(18,8), qty decimal(18,8), aggressor_side string"
    one = Decimal(1)
    trades = spark.createDataFrame([("S", "A", 0, 0, one, one, "BUY"), ("S", "A", 2, 10 * S, one, one, "SELL"), ("S", "A", 4, 10 * S, one, one, "BUY")], schema)
    ticks = spark.createDataFrame([("S", "A", 3, 10 * S), ("S", "A", 5, 10 * S + 1)], "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint")
    got = by_seq(history.trade_flow(ticks, trades), "count_10s", "buy_10s", "sell_10s", "imbalance_10s")
    # a trade exactly 10 s ago counts, one captured after the tick doesn't; a nanosecond later the first is gone
    assert got == [(2, one, one, 0.0), (2, one, one, 0.0)]
    empty = by_seq(history.trade_flow(ticks, trades.limit(0)), "count_1s", "total_1s", "imbalance_1s")
    assert empty == [(0, Decimal(0), None)] * 2


def test_split_purges(spark):
    rows = labels.chronological_split(frame(spark, [(i, 100) for i in range(100)]), 10 * S).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in rows} == {"train": 50, "validation": 10, "test": 20}
    ms = [0, 100, 200, 300, 400, 1000, 1100, 1200, 2000, 2100]
    parts = labels.chronological_split(frame(spark, [(m / 1000, 100) for m in ms]), 150_000_000)
    last = {r["part"]: r["m"] // 1_000_000 for r in parts.groupBy("part").agg(F.max("monotonic_ns").alias("m")).collect()}
    assert last["train"] == 200 or last["train"] <= 400


def test_running_sum_and_rank_match_plain_windows(spark):
    from pyspark.sql import Window

    df = spark.range(500).select(F.lit("S").alias("capture_session_id"), F.lit("A").alias("symbol"), F.col("id").alias("capture_seq"), (F.col("id") * 7919 % 31).alias("v"))
    w = Window.partitionBy("symbol").orderBy("capture_seq")
    want = by_seq(df.withColumn("s", F.sum("v").over(w)), "s")
    assert by_seq(series.running_sum(df, F.col("v"), "s", size=32), "s") == want
    r = Window.partitionBy("symbol").orderBy("v", "capture_seq")
    assert by_seq(series.ranked(df, ["v", "capture_seq"], ["symbol"]), "rn") == by_seq(df.withColumn("rn", F.row_number().over(r)), "rn")


def test_average_ranks_share_ties(spark):
    values = [3, 1, 1, 2, 2, 2, 9]
    got = {r["v"]: r["rank"] for r in series.average_ranks(spark.createDataFrame([("A", v) for v in values], "symbol string, v int"), "v", ["symbol"], "rank").collect()}
    assert got == {1: 1.5, 2: 4.0, 3: 6.0, 9: 7.0}


def test_rows_of_one_instant_see_no_later_one(spark):
    df = frame(spark, [(0, 100), (1, 101), (1, 150), (2, 150)])
    vol = by_seq(history.realized_volatility(df, {"5s": 5 * S}), "realized_volatility_5s")
    want = [None, abs(math.log(1.01)), abs(math.log(1.5)), abs(math.log(1.5))]
    assert [v for (v,) in vol] == [w if w is None else pytest.approx(w) for w in want]
    back = by_seq(history.backward_returns(df, {"1s": S}), "return_1s")
    assert [v for (v,) in back] == [None, pytest.approx(math.log(1.01)), pytest.approx(math.log(1.5)), pytest.approx(0)]


def test_nothing_crosses_an_epoch(spark):
    df = frame(spark, [(0, 100), (1, 110), (2, 121), (3, 133.1)])
    seqs = sorted(r["capture_seq"] for r in df.collect())
    marks = df.where(F.col("capture_seq") == seqs[2])
    cut = history.with_epochs(df, marks.withColumn("capture_seq", F.col("capture_seq") - 0))
    made = history.backward_returns(cut, {"1s": S}, keys=[*history.KEYS, "epoch"]).orderBy("capture_seq").collect()
    assert [r["epoch"] for r in made] == [0, 0, 1, 1] and [r["return_1s"] is None for r in made] == [True, False, True, False]


def test_intervals_have_no_longest(spark):
    got = by_seq(clock.intervals(frame(spark, [(0, 1), (1, 1), (9000, 1), (9000, 1), (30000, 1)])), "interval_ms")
    assert [v for (v,) in got] == [None, 1000, 8999000, 0, 21000000]


def test_non_overlapping_is_greedy(spark):
    rng = random.Random(2)
    t, ts = 0, []
    for _ in range(200):
        t += rng.choice([1, 2, 3, 30])
        ts.append(t / 10)
    got = [n for (n,) in by_seq(signals.non_overlapping(frame(spark, [(x, 1) for x in ts]), 2 * S), "monotonic_ns")]
    want, due = [], -1
    for x in ts:
        if round(x * S) >= due:
            want.append(round(x * S))
            due = round(x * S) + 2 * S
    assert got == want


def test_regimes_stability_bootstrap(spark):
    df = spark.createDataFrame([("A", float(v)) for v in (1, 4, 100)], "symbol string, v double")
    assert {r["v"]: r["regime"] for r in stats.volatility_regimes(df, ["symbol"], "v").collect()} == {1.0: "LOW", 4.0: "MEDIUM", 100.0: "HIGH"}
    row = stats.stability(spark.createDataFrame([("A", v) for v in (0.08, 0.03, -0.01, None)], "symbol string, v double"), ["symbol"], "v").first()
    assert (row["usable"], row["median"], row["same_sign"]) == (3, 0.03, pytest.approx(2 / 3))
    rows = frame(spark, [(i, 100, True, 1.0 if i % 2 else -1.0) for i in range(100)]).withColumn("y", F.col("x") * 0.001)
    ci = stats.block_bootstrap(stats.block_sums(rows, ["symbol"]), ["symbol"])
    first, again = ci.first(), ci.first()
    assert first == again and first["block_count"] == 10 and first["low"] <= first["estimate"] <= first["high"]
    single = stats.block_bootstrap(stats.block_sums(rows.where("capture_seq < 5"), ["symbol"]), ["symbol"]).first()
    assert single["block_count"] == 1 and single["low"] is None
    ess = stats.effective_sample_size(frame(spark, [(i, 1, True, i % 5) for i in range(60)]), ["symbol"], "capture_seq").first()
    assert 1 <= ess["ess"] <= 60
    assert stats.effective_sample_size(frame(spark, [(i, 1, True, 3) for i in range(10)]), ["symbol"], "capture_seq").first()["ess"] == 1.0


def test_correlations_and_costs(spark):
    rows = frame(spark, [(i / 10, 100, True, (i - 10) / 10) for i in range(21)]).withColumn("y", F.col("x") * 0.001)
    row = stats.correlations(rows, ["symbol"]).first()
    assert row["pearson"] == pytest.approx(1) and row["spearman"] == pytest.approx(1)
    costs = {r["cost_bps"]: r for r in stats.cost_sensitivity(spark.createDataFrame([(0.4,)], "edge_bps double"), costs=(0.0, 0.5)).collect()}
    assert costs[0.5]["net_bps"] == pytest.approx(-0.1) and costs[0.0]["edge_to_cost"] is None


def test_shadow_pnl_symmetry(spark):
    for sign, exit_mid in ((1, 101.0), (-1, 99.0)):
        t = spark.createDataFrame([("LONG" if sign > 0 else "SHORT", 0, S, 100.0, exit_mid, 2.0, 2.0, max(100.0, exit_mid), min(100.0, exit_mid))], "side string, entry_ns bigint, exit_ns bigint, entry_mid double, exit_mid double, entry_spread_bps double, exit_spread_bps double, path_max double, path_min double")
        row = signals.priced(t, signals.Costs(taker_fee_bps=1.0), 1000.0).first()
        assert row["gross_pnl"] == pytest.approx(10) and row["net_pnl"] == pytest.approx(10 - row["fees"] - row["slippage_cost"])
        assert row["entry_price"] == pytest.approx(100 * (1 + sign * 1e-4))
    maker = signals.priced(t, signals.Costs(maker_entry=True)).first()
    assert maker["entry_price"] == 100.0
    with pytest.raises(ValueError):
        signals.Costs(taker_fee_bps=-1)


def test_fragments_and_state_carry(spark):
    rows = spark.createDataFrame([("S", "A", i, h) for i, h in enumerate(["2024-01-01 00:10:00", "2024-01-01 00:50:00", "2024-01-01 01:05:00", "2024-01-01 00:59:00"])], "capture_session_id string, symbol string, capture_seq bigint, t string").withColumn("ts", F.to_timestamp("t"))
    assert by_seq(clock.hour_fragments(rows), "fragment") == [(1,), (1,), (2,), (3,)]
    step = clock.wall_clock_steps(rows).first()
    assert (step["backward_steps"], step["last_seq"]) == (1, 3)
    events = spark.range(10).select(F.lit("S").alias("capture_session_id"), F.lit("A").alias("symbol"), (F.col("id") * 10).alias("capture_seq"))
    states = spark.createDataFrame([("S", "A", 25, 7.0)], "capture_session_id string, symbol string, capture_seq bigint, v double")
    assert [v for (v,) in by_seq(clock.latest_before(events, states, ["v"], size=16), "v")] == [None] * 3 + [7.0] * 7
