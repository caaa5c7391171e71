"""Sessions and sliding sums of streams equal those of batches."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.sources import projections
from tidemark.streaming import counts, windows
from tidemark.streaming.windows import SECOND

SF = "/root/testdata/sf0.001"


def in_batches(df, path, cuts):
    for i, (lo, hi) in enumerate(zip(cuts, [*cuts[1:], 1 << 60])):
        df.where((F.col("capture_seq") >= lo) & (F.col("capture_seq") < hi)).coalesce(1).write.parquet(f"{path}/{i}")
    return counts.stream_of(df.sparkSession, f"{path}/*", df.schema)


def test_sliding_sums_equal_the_batch_frames(spark, tmp_path):
    obs = projections.observations(spark, SF)
    trades, ticks = projections.trades(obs), obs.where("event_type = 'signup'").select(*projections.KEYS, "capture_seq", "monotonic_ns")
    both = trades.select(*ticks.columns, F.lit("trade").alias("kind"), "price", "qty", "aggressor_side").unionByName(ticks.withColumn("kind", F.lit("tick")), allowMissingColumns=True)
    stream = in_batches(both, str(tmp_path / "in"), [0, 10, 300, 301, 700])
    counts.drain(windows.trade_flow(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    got, wanted = spark.read.parquet(str(tmp_path / "out")), history.trade_flow(ticks, trades)
    assert got.count() == wanted.count() > 100
    assert got.select(*wanted.columns).exceptAll(wanted).isEmpty()


@pytest.mark.parametrize("seed", range(5))
def test_panes(seed):
    rng = random.Random(seed)
    own, trades, t = windows.Panes(100), [], 0
    for _ in range(400):
        t += rng.choice([0, 1, 7, 99, 100, 250])
        if rng.random() < 0.6:
            trades.append((t, rng.randint(1, 9), rng.randint(1, 9), rng.random() < 0.5))
            own.add(*trades[-1])
        else:
            for size in (100, 350, 1000):
                seen = [x for x in trades if t - size <= x[0] <= t]
                assert own.total(t - size, t) == [sum(q for _, _, q, b in seen if b), sum(q for _, _, q, b in seen if not b), sum(p * q for _, p, q, _ in seen), len(seen)]
            own.drop_before(t - 1000)
    assert len(own.panes) <= 12 and own.gone


def test_sessions_equal_islands(spark, tmp_path):
    rng, rows, t = random.Random(3), [], 0
    for i in range(300):
        t += rng.choice([SECOND // 2, SECOND, 3 * SECOND, 3 * SECOND + 1000, 9 * SECOND])
        rows.append(("S", rng.choice("ab"), i, t))
    frame = spark.createDataFrame(rows, "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint")
    wanted, open_ = [], {}
    for _, symbol, seq, ns in rows:
        own = open_.get(symbol)
        if own and ns - own[2] <= 3 * SECOND:
            own[2], own[4], own[5] = ns, seq, own[5] + 1
        else:
            open_[symbol] = [symbol, ns, ns, seq, seq, 1]
            wanted.append(open_[symbol])
    names = ["symbol", "start_ns", "end_ns", "first_seq", "last_seq", "rows"]
    read = lambda df: sorted(tuple(r) for r in df.select(*names).collect())
    assert read(windows.sessions(frame)) == sorted(map(tuple, wanted))
    stream = in_batches(frame, str(tmp_path / "in"), [0, 50, 120, 121, 250])
    counts.drain(windows.sessions(stream, late="0 seconds"), str(tmp_path / "out"), str(tmp_path / "cp"))
    done = read(spark.read.parquet(str(tmp_path / "out")))
    closed = [tuple(w) for w in wanted if w[2] + 3 * SECOND + 1000 < t]  # the watermark is the last row's time
    assert set(done) <= set(map(tuple, wanted)) and len(done) == len(set(done)) and set(closed) <= set(done)
