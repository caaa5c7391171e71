"""Greedy spacing by jump maps against the scan itself."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import spacing


def scanned(times, horizon):
    out, due = [], None
    for t in times:
        if due is None or t >= due:
            out.append(t)
            due = t + horizon
    return out


@pytest.mark.parametrize("seed", range(40))
def test_steps_compose(seed):
    """Chunks, groups of chunks and the whole lead to the same due times from any start."""
    rng = random.Random(seed)
    horizon, chunk = rng.choice([1, 7, 30]), rng.choice([30, 50])
    times = np.array(sorted(rng.sample(range(600), rng.choice([3, 40, 400]))), np.int64)
    parts = [times[(times >= c * chunk) & (times < (c + 1) * chunk)] for c in range(600 // chunk)]
    steps = [spacing.chunk_steps(p, c * chunk, horizon) for c, p in enumerate(parts)]
    whole = spacing.composed(steps, 0, horizon)
    for due in range(horizon + 1):
        last = [t for t in times.tolist() if t >= due]
        got = scanned(last, horizon)
        wanted = got[-1] + horizon if got else due
        assert spacing._leave(*whole, np.array([due]))[0] == wanted
        assert times[spacing.kept(times, due, horizon)].tolist() == got


@pytest.mark.parametrize(("step", "chunk", "group"), [(100, 2_000, 4), (1, 50, 3), (900, 5_000, 1024)])
def test_series_without_gaps_and_with(spark, step, chunk, group):
    rng, rows, wanted = random.Random(step), [], set()
    for symbol in "ab":
        t, times = -3 * chunk, []
        for i in range(900):
            t += rng.choice([0, step, step, 2 * step]) if symbol == "a" or i % 200 else 7 * chunk
            times.append(t)
            rows.append(("S", symbol, i, t))
        first = {}
        for r in rows:
            if r[1] == symbol:
                first.setdefault(r[3], r[2])
        wanted |= {(symbol, first[x]) for x in scanned(times, 1_000)}
    rows.append(("S", "a", 5000, None))
    got = spacing.non_overlapping(spark.createDataFrame(rows, "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint"), 1_000, chunk_ns=chunk, group_chunks=group)
    assert {(r.symbol, r.capture_seq) for r in got.collect()} == wanted and got.count() == len(wanted)
    assert got.columns == ["capture_session_id", "symbol", "capture_seq", "monotonic_ns"]


def test_one_series_is_many_tasks(spark):
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        grid = spark.range(5000).select(F.lit("S").alias("capture_session_id"), F.lit("A").alias("symbol"), F.col("id").alias("capture_seq"), (F.col("id") * 100).alias("monotonic_ns"))
        got = spacing.non_overlapping(grid, 1_000, chunk_ns=10_000).withColumn("task", F.spark_partition_id()).collect()
        assert sorted(r.capture_seq for r in got) == list(range(0, 5000, 10))
        assert len({r.task for r in got}) >= 8
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", before)
