"""Gates, rates, guards, wire payloads, symbol rules, the catalog's versions, and the feature engine's known answers."""

from __future__ import annotations

import math
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.operators import engine, health, labels
from tidemark.operators.checks import IntegrityError
from tidemark.sources import schemas, verify

SERIES = "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint"
S = 1_000_000_000


def test_gates_rates_and_slopes(spark):
    rows = [("S", "a", i, i * 2 * S, float(i if i < 6 else 6 + 3 * (i - 6)), 10 * i) for i in range(10)] + [("S", "b", 0, 0, 1.0, 5)]
    df = spark.createDataFrame(rows, SERIES + ", v double, n bigint").withColumn("t", F.col("monotonic_ns") / S)
    rates = {(r.symbol, r.capture_seq): r.n_rate for r in health.rates(df, ["n"]).collect()}
    assert rates["a", 0] is None and rates["b", 0] is None and rates["a", 4] == 5.0
    slopes = {r.symbol: (r.slope_late, r.slope_all) for r in health.late_slopes(df, {"late": 6.0, "all": 100.0}, "t", "v").collect()}
    assert slopes["a"][0] == pytest.approx(1.5) and 0.5 < slopes["a"][1] < 1.0 and slopes["b"] == (None, None)
    one = spark.createDataFrame([(1, None), (5, 0), (1, 0)], "x int, y int")
    got = health.decided(one, {"big": F.col("x") > 3}, {"y": F.col("y") > 0, "x": F.col("x") > 4}).orderBy(F.desc("x"), F.desc_nulls_last("y")).collect()
    assert [(r.decision, r.failure_reasons, r.warning_reasons) for r in got] == [("FAIL", ["big"], ["x"]), ("PASS", [], []), ("WARNING", [], ["y"])]


def test_guards(spark):
    df = spark.createDataFrame([("S", "a", 0, 5), ("S", "a", 1, 5), ("S", "a", 2, 6), ("S", "b", 3, 1)], SERIES)
    assert [(r.capture_seq, r.prev_monotonic_ns) for r in health.not_rising(df).collect()] == [(1, 5)]
    assert [(r.symbol, r.n) for r in health.over_capacity(df, 2, ["symbol"]).collect()] == [("a", 3)]
    levels = spark.createDataFrame([(1, "bid", p) for p in (1, 2, 3)] + [(1, "ask", p) for p in (4, 5)], "book_id int, side string, price int")
    assert {(r.side, r.price) for r in health.best_levels(levels, ["book_id"], 2).collect()} == {("bid", 3), ("bid", 2), ("ask", 4), ("ask", 5)}
    with pytest.raises(Exception, match="hard limit"):
        health.best_levels(levels, ["book_id"], 1, hard_limit=2).collect()
    row = spark.range(1).select(health.scheduling_lag_ms(F.lit(5_000_000), F.lit(3_000_000)).alias("lag"), *[c.alias(n) for n, c in health.sampled_clock(F.lit(100), F.lit(200), F.lit(170), F.lit(0), F.lit(7_000_000), 5.0).items()]).first()
    assert tuple(row) == (0.0, 20.0, 7.0, False)
    made = spark.createDataFrame([(1.5,)], "future_return_1s double")
    assert made.select(labels.label_value("future_return_1s", made)).first()[0] == 1.5
    for wrong in ("future_return_9s", "mid"):
        with pytest.raises(KeyError):
            labels.label_value(wrong, made)


def test_wire_payloads(spark):
    wire = ['{"data":{"e":"bookTicker","E":1,"T":2,"s":"btcusdc","u":9,"b":"99.5","B":"2","a":"100.5","A":"3"}}', '{"e":"depthUpdate","E":1,"T":2,"s":"BTCUSDC","U":1,"u":3,"pu":0,"b":[["99","1"],["98","0"]],"a":[]}', '{"e":"trade","E":1,"T":2,"s":"x","t":4,"p":"1","q":"0","m":true}']
    got = {r.kind: r for r in schemas.parse_wire(spark.createDataFrame([(w,) for w in wire], "value string")).collect()}
    assert set(got) == {"bookTicker", "depthUpdate"} and got["bookTicker"].symbol == "BTCUSDC" and got["bookTicker"].best_ask_quantity == D(3) and got["bookTicker"].bids is None
    assert [tuple(x) for x in got["depthUpdate"].bids] == [(D(99), D(1)), (D(98), D(0))] and got["depthUpdate"].asks == [] and got["depthUpdate"].best_bid_price is None


def test_symbol_rules(spark):
    schema = "symbol string, status string, contractType string, filters array<struct<filterType:string,tickSize:string,stepSize:string,minQty:string,notional:string>>"
    price, lot, notional = ("PRICE_FILTER", "0.1", None, None, None), ("LOT_SIZE", None, "0.001", "0.002", None), ("MIN_NOTIONAL", None, None, None, "5")
    read = lambda *filters, status="TRADING": schemas.symbol_rules(spark.createDataFrame([("A", status, "PERPETUAL", list(filters))], schema)).collect()[0]
    assert tuple(read(price, lot, notional)) == ("A", D("0.1"), D("0.001"), D("0.002"), D(5)) and read(price, lot).min_notional is None
    for filters, what in (((lot,), "tick"), ((price,), "step"), ((price, ("LOT_SIZE", None, "0.1", None, None)), "least"), ((("PRICE_FILTER", "0", None, None, None), lot), "tick")):
        with pytest.raises(Exception, match=f"missing filter.*{what}"):
            read(*filters)
    with pytest.raises(Exception, match="not a trading perpetual"):
        read(price, lot, status="BREAK")


def test_catalog_versions_and_frozen_sources(spark, tmp_path):
    root = str(tmp_path / "catalog")
    own = lambda *ids: spark.createDataFrame([(f"d{i}", f"f{i}.parquet", "S1" if i < 2 else "S2", i, f"sha{i}") for i in ids], "dataset_id string, file_path string, capture_session_id string, first_capture_seq bigint, sha256 string")
    with pytest.raises(IntegrityError, match="no catalog"):
        verify.entries(spark, root)
    assert (verify.register(spark, root, own(0, 1)), verify.register(spark, root, own(2))) == (1, 2)
    assert verify.entries(spark, root).count() == 3 and verify.entries(spark, root, "S2").count() == 1
    for again in (own(1), own(5, 5)):
        with pytest.raises(IntegrityError, match="registered already"):
            verify.register(spark, root, again)
    assert verify.entries(spark, root).count() == 3
    frozen = str(tmp_path / "frozen")
    assert verify.frozen_sources(spark, frozen, own(0, 1).select("file_path")).count() == 0
    verify.freeze(own(1, 2), frozen)
    assert [r.file_path for r in verify.frozen_sources(spark, frozen, own(0, 1).select("file_path")).collect()] == ["f1.parquet"]
    summaries = spark.createDataFrame([("S1", "FINALIZED", False), ("S3", "FINALIZED", True)], "capture_session_id string, status string, dataset_valid boolean")
    assert sorted(tuple(r) for r in verify.unfinished_sessions(own(0, 2), summaries).collect()) == [("S1", "UNFINISHED"), ("S2", "MISSING")]


def event(seq, ms, kind, **own):
    book = dict(best_bid_price=D(99), best_bid_quantity=D(1), best_ask_price=D(101), best_ask_quantity=D(1), resync_count=0, healthy=True, receive_ns=None, book_age_ms=0.0, update_id=seq) if kind == "book" else {}
    return {**dict.fromkeys([*engine.BOOK, "price", "qty", "aggressor_side"]), "capture_session_id": "S", "symbol": "A", "capture_seq": seq, "monotonic_ns": ms * 1_000_000, "kind": kind, **book, **own}


def ticks(spark, events):
    schema = f"{SERIES}, kind string, price decimal(18,8), qty decimal(18,8), aggressor_side string, best_bid_price decimal(18,8), best_bid_quantity decimal(18,8), best_ask_price decimal(18,8), best_ask_quantity decimal(18,8), resync_count bigint, healthy boolean, receive_ns bigint, book_age_ms double, update_id bigint"
    names = [c.split()[0] for c in schema.replace("decimal(18,8)", "d").split(", ")]
    return {r.capture_seq: r for r in engine.feature_engine(spark.createDataFrame([tuple(e[n] for n in names) for e in events], schema)).collect()}


def test_feature_engine_known_answers(spark):
    up = {"best_bid_price": D(109), "best_ask_price": D(111)}
    got = ticks(spark, [
        event(0, 0, "tick"), event(1, 0, "connected"), event(2, 0, "book"), event(3, 500, "book", **up), event(4, 500, "tick"), event(5, 1000, "tick"), event(6, 1500, "trade", price=D(100), qty=D(2), aggressor_side="BUY"), event(7, 1500, "tick"),
        event(8, 1600, "invalidated"), event(9, 1700, "tick"), event(10, 1800, "book"), event(11, 1900, "tick"), event(12, 2000, "book", resync_count=1, **up), event(13, 3100, "tick"), event(14, 9000, "tick"),
        event(15, 9100, "disconnected"), event(16, 9200, "connected"), event(17, 9200, "book", resync_count=1, best_ask_price=D(99), best_bid_quantity=D(0)), event(18, 9300, "tick"),
    ])
    assert 0 not in got and sorted(got) == [4, 5, 7, 9, 11, 13, 14, 18]
    assert (got[4].return_250ms, got[4].return_1s) == (pytest.approx(math.log(1.1)), None) and got[5].return_1s == pytest.approx(math.log(1.1)) and got[5].return_250ms == 0
    assert got[4].realized_volatility_1s == pytest.approx(math.log(1.1)) and got[7].realized_volatility_1s is None
    assert (got[7].count_1s, float(got[7].buy_1s), got[7].trade_stream_age_ms, got[7].book_age_ms, got[7].feature_valid) == (1, 2.0, 0.0, 1000.0, True)
    assert list(got[9].invalid_reasons) == ["BOOK_UNHEALTHY"] and got[9].return_250ms is None and got[9].book_last_update_id == 3
    assert got[11].return_250ms is None and got[11].feature_valid
    # another resynchronisation starts a history anew: the book before it is forgotten
    assert got[13].return_1s == 0 and got[13].realized_volatility_5s is None
    assert list(got[14].invalid_reasons) == ["BOOK_STALE", "TRADE_STREAM_UNHEALTHY"] and got[14].count_10s is None
    assert list(got[18].invalid_reasons) == ["INVALID_SPREAD", "INVALID_TOP_OF_BOOK"] and got[18].count_10s == 0
