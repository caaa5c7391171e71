from __future__ import annotations

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.functions import prices
from tidemark.operators import book, checks
from tidemark.sources import catalog, projections, schemas
from tidemark.streaming import books, counts

SF = "/root/testdata/sf0.001"


def test_book_agrees_with_a_dict_model():
    rng = random.Random(9)
    own, bids, asks = book.Book(), {D(99): D(1)}, {D(101): D(1)}
    own.load(1, list(bids.items()), list(asks.items()))
    for i in range(500):
        side, other = (bids, asks) if rng.random() < 0.5 else (asks, bids)
        price = D(rng.randint(90, 110))
        qty = D(rng.choice([0, 1, 2]))
        trial = dict(side)
        if qty:
            trial[price] = qty
        else:
            trial.pop(price, None)
        b, a = (trial, other) if side is bids else (other, trial)
        level = [(price, qty)]
        if not b or not a or max(b) >= min(a):
            with pytest.raises(book.BookError):
                own.apply(i, level if side is bids else [], level if side is asks else [])
        else:
            own.apply(i, level if side is bids else [], level if side is asks else [])
            side.clear()
            side.update(trial)
        assert own.top(50) == (sorted(bids.items(), reverse=True), sorted(asks.items()))


def test_reconstruction_bridges_compares_and_counts_gaps(spark):
    lv = "array<struct<price:decimal(18,8),quantity:decimal(18,8)>>"
    schema = f"capture_session_id string, symbol string, capture_seq bigint, kind string, first_id bigint, final_id bigint, previous_id bigint, bids {lv}, asks {lv}, snapshot_limit int, buffered_ids array<bigint>"
    bid, ask = [(D(100), D(1))], [(D(102), D(1))]
    rows = [
        ("S", "A", 0, "lifecycle", None, None, None, None, None, None, None),
        ("S", "A", 1, "depth", 99, 101, 98, [(D(100), D(2))], [], None, None),
        ("S", "A", 2, "bootstrap", None, 100, None, bid, ask, 1000, [101]),
        ("S", "A", 3, "trusted", None, 101, None, [(D(100), D(2))], ask, None, None),
        ("S", "A", 4, "depth", 102, 103, 101, [(D(100), D(0)), (D(99), D(4))], [], None, None),
        ("S", "A", 5, "trusted", None, 103, None, [(D(99), D(5))], ask, None, None),
        ("S", "A", 6, "depth", 110, 111, 109, [], [], None, None),
        ("S", "A", 7, "trusted", None, 111, None, bid, ask, None, None),
    ]
    rows += [
        ("S", "A", 8, "bootstrap", None, 200, None, bid, ask, 1000, []),
        ("S", "A", 9, "trusted", None, 200, None, bid, ask, None, None),
        ("S", "A", 10, "depth", 150, 160, 149, [(D(100), D(9))], [], None, None),
        ("S", "A", 11, "depth", 199, 200, 150, [(D(101), D(3))], [], None, None),
        ("S", "A", 12, "depth", 199, 200, 150, [(D(101), D(3))], [], None, None),
        ("S", "A", 13, "trusted", None, 200, None, [(D(101), D(3)), (D(100), D(1))], ask, None, None),
        ("S", "A", 14, "depth", 201, 202, 200, [(D(103), D(1))], [], None, None),
        ("S", "A", 15, "trusted", None, 202, None, bid, ask, None, None),
        ("S", "A", 16, "bootstrap", None, 300, None, bid, ask, 1000, [299]),
        ("S", "A", 17, "trusted", None, 300, None, bid, ask, None, None),
        ("S", "B", 18, "trusted", None, 1, None, bid, ask, None, None),
    ]
    got = book.reconstruct(spark.createDataFrame(rows, schema)).orderBy("capture_seq").collect()
    assert [(r["ok"], r["error"], r["gaps"]) for r in got[:3]] == [(True, None, 0), (False, "bids", 0), (False, "no synchronized book", 1)]
    assert [(r["ok"], r["error"]) for r in got[3:]] == [(False, "not bridged"), (True, None), (False, "invalid depth: crossed"), (False, "missing buffered depth event 299"), (False, "no synchronized book")]
    full = spark.createDataFrame(rows, schema).withColumn("best_bid_price", F.when(F.col("capture_seq") == 13, D(101)).otherwise(D(1))).withColumn("spread", F.when(F.col("capture_seq") == 13, D(1)).otherwise(D(7)))
    errors = {r["capture_seq"]: r["error"] for r in book.reconstruct(full).collect()}
    assert errors[13] is None and errors[3] == "best_bid_price, spread"


def test_price_formulas(spark):
    df = spark.createDataFrame([(D("100"), D("1"), D("102"), D("3"))], "b decimal(18,8), bq decimal(18,8), a decimal(18,8), aq decimal(18,8)")
    row = df.select(prices.mid(F.col("b"), F.col("a")).alias("m"), prices.microprice(F.col("b"), F.col("bq"), F.col("a"), F.col("aq")).alias("mp"), prices.imbalance(F.col("bq"), F.col("aq")).alias("i"), prices.backpressure(F.lit(8.0), F.lit(10.0)).alias("p")).first()
    assert (float(row["m"]), row["mp"], row["i"], row["p"]) == (101.0, 100.5, -0.5, "WARNING")
    r = spark.range(1).select(book.bridges(F.lit(5), F.lit(9), F.lit(9)).alias("x"), book.bridges(F.lit(5), F.lit(9), F.lit(10)).alias("y")).first()
    assert (r["x"], r["y"]) == (True, False)


def test_schemas_bring_old_versions_up_to_date(spark):
    with pytest.raises(KeyError):
        schemas.raw_schema("trade", 9)
    old = spark.createDataFrame([], schemas.raw_schema("clock_sample", 1))
    assert "accepted" in schemas.decoded(old, "clock_sample").columns
    wire = spark.createDataFrame([('{"data":{"e":"aggTrade","E":1,"s":"btc","a":7,"p":"1.5","q":"2","f":1,"l":1,"T":1000,"m":true}}',), ('{"e":"trade","E":1,"T":1,"s":"x","t":1,"p":"0","q":"0","m":false}',)], "value string")
    got = schemas.parse_wire(wire).collect()
    assert [(r["symbol"], r["trade_id"], r["aggressor_side"]) for r in got] == [("BTC", 7, "SELL")]
    with pytest.raises(Exception, match="unknown event type"):
        schemas.parse_wire(spark.createDataFrame([('{"e":"other"}',)], "value string")).collect()


def test_catalog_freeze_compact_recover(spark, tmp_path):
    obs = projections.observations(spark, SF).withColumn("local_time", F.col("ts"))
    path = str(tmp_path / "raw")
    obs.repartition(6, "symbol").write.partitionBy("symbol").parquet(path)
    table = spark.read.parquet(path)
    files = catalog.manifests(table, "obs").cache()
    assert files.agg(F.sum("row_count")).first()[0] == obs.count()
    frozen = catalog.freeze(files)
    catalog.verify_frozen(frozen, files)
    with pytest.raises(checks.IntegrityError):
        catalog.verify_frozen({**frozen, "symbols": []}, files)
    assert catalog.compact(spark, path, str(tmp_path / "out"), ["symbol"], rows_per_file=400) >= 2
    with pytest.raises(Exception, match="exists"):
        catalog.compact(spark, path, str(tmp_path / "out"), ["symbol"])
    one = files.limit(1).cache()
    lost = catalog.recovery(files, files.join(one, "file_path", "left_anti").select("file_path")).collect()
    assert [r["problem"] for r in lost] == ["MISSING"]
    bins = catalog.compaction_bins(files, max_files=1)
    assert bins.count() == files.count()
    assert catalog.ordered_digest(table.select("symbol", "capture_seq", "k"), ["symbol"]).orderBy("symbol").collect() == catalog.ordered_digest(obs.select("symbol", "capture_seq", "k"), ["symbol"]).orderBy("symbol").collect()
    assert catalog.stable_fingerprint({"b": 1, "a": 2}) == catalog.stable_fingerprint({"a": 2, "b": 1})
    assert catalog.same_json((1, 2), [1, 2]) and not catalog.same_json(True, 1) and not catalog.same_json([1, 2], [2, 1])
    catalog.write_json(str(tmp_path / "x.json"), {"a": 1})
    with pytest.raises(ValueError):
        catalog.write_json(str(tmp_path / "y.json"), {"a": float("nan")})


def test_checks_find_what_they_should(spark):
    rows = spark.createDataFrame([("S", "A", 0, 0), ("S", "A", 1, 5), ("S", "A", 1, 5), ("S", "A", 3, 4)], "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint")
    got = sorted((r["capture_seq"], r["error"]) for r in checks.sequence_violations(rows).collect())
    assert got == [(1, "DUPLICATE"), (3, "CLOCK_BACK"), (3, "GAP")]
    with pytest.raises(checks.IntegrityError):
        checks.require_none(checks.sequence_violations(rows), "order")
    assert checks.content_equal(rows, rows.orderBy(F.desc("capture_seq"))) and not checks.content_equal(rows, rows.distinct())


def test_streams_equal_batches(spark, tmp_path):
    obs = projections.observations(spark, SF)
    path = str(tmp_path / "in")
    obs.repartitionByRange(4, "capture_seq").sortWithinPartitions("capture_seq").write.parquet(path)
    stream = counts.tumbling_counts(counts.stream_of(spark, path, obs.schema, 4), late="0 seconds")
    counts.drain(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    done = spark.read.parquet(str(tmp_path / "out"))
    batch = counts.tumbling_counts(obs)
    assert done.exceptAll(batch).isEmpty() and done.count() >= batch.count() - 4  # the last open hours wait for the watermark

    updates = obs.select("symbol", "capture_seq", F.when(F.col("k") % 2 == 0, "bid").otherwise("ask").alias("side"), F.col("price").cast("double").alias("price"), F.lit(1.0).alias("quantity"))
    flat = str(tmp_path / "upd")
    updates.coalesce(1).sortWithinPartitions("capture_seq").write.parquet(flat)
    counts.drain(books.top_of_book(counts.stream_of(spark, flat, updates.schema)), str(tmp_path / "top"), str(tmp_path / "cp2"))
    top = {(r["symbol"], r["capture_seq"]): (r["best_bid"], r["best_ask"]) for r in spark.read.parquet(str(tmp_path / "top")).collect()}
    model: dict = {}
    for r in updates.orderBy("capture_seq").collect():
        own = model.setdefault(r["symbol"], {"bid": set(), "ask": set()})
        own[r["side"]].add(r["price"])
        b, a = top[r["symbol"], r["capture_seq"]]
        assert (None if b != b else b, None if a != a else a) == (max(own["bid"], default=None), min(own["ask"], default=None))
