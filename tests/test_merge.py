"""Moments of parts merge to the whole's correlation wherever the means lie; medians come from ranks."""

from __future__ import annotations

import random
from statistics import median

import numpy as np
import pytest

from tidemark.operators import series, stats


@pytest.mark.parametrize("mean", [0.0, 1e6, 1e8])
def test_merged_correlation(spark, mean):
    rng = random.Random(6)
    rows = []
    for i in range(2000):
        x = rng.gauss(0, 1)
        rows.append(("a", i % 10, mean + x, -mean + 0.5 * x + rng.gauss(0, 1)))
    rows += [(None, 0, 1.0, 2.0), (None, 1, 2.0, 4.0), (None, 2, 3.0, 6.5), ("two", 0, 1.0, 1.0), ("two", 1, 2.0, 2.0), ("flat", 0, 1.0, 1.0), ("flat", 0, 1.0, 2.0), ("flat", 1, 1.0, 3.0)]
    parts = stats.moments(spark.createDataFrame(rows, "k string, part int, x double, y double"), ["k", "part"])
    got = {r.k: (r.n, r.correlation) for r in stats.merged_correlation(parts, ["k"]).collect()}
    x, y = np.array([r[2:] for r in rows if r[0] == "a"]).T
    assert got["a"] == (2000, pytest.approx(np.corrcoef(x - mean, y + mean)[0, 1], abs=1e-7))
    assert got[None][1] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1]) and got["two"] == (2, None) and got["flat"] == (3, None)


def test_median_from_ranks(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), float(rng.randint(0, 9))) for _ in range(200)] + [("one", 4.0), ("two", 1.0), ("two", 4.0)]
    placed = series.ranked(spark.createDataFrame(rows, "k string, v double"), ["v"], ["k"])
    got = {r.k: r.m for r in placed.groupBy("k").agg(stats.middle(placed, "v").alias("m")).collect()}
    assert got == {k: median(v for x, v in rows if x == k) for k in {r[0] for r in rows}}


def test_release_deletes_shared_tables(spark):
    import os

    from tidemark.session import own_folder, release, shared_table

    kept = shared_table(spark.range(3).toDF("i"), "t")
    folder = own_folder(spark).removeprefix("file:")
    assert kept.count() == 3 and os.listdir(folder)
    release(spark)
    assert not os.path.exists(folder)


@pytest.mark.parametrize("difference", [False, True])
def test_bootstrap_by_joins(spark, difference):
    rng = random.Random(3)
    rows = [(k, b, rng.random(), rng.choice([0, 1, 3]), rng.random(), rng.choice([0, 2])) for k, n in (("a", 9), ("b", 2), ("one", 1)) for b in rng.sample(range(50), n)]
    blocks = spark.createDataFrame(rows, "k string, block bigint, high_sum double, high_count bigint, low_sum double, low_count bigint")
    draw = lambda rep, place, n: (rep * 13 + place * 7 + rep * place) % n
    got = {r.k: tuple(r)[1:] for r in stats.resampled(blocks, ["k"], 40, difference, draw).collect()}

    def ratio(some):
        hs, hc, ls, lc = (sum(r[i] for r in some) for i in range(2, 6))
        return None if not hc or (difference and not lc) else hs / hc - (ls / lc if difference else 0)

    for k in ("a", "b", "one"):
        own = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        n = len(own)
        draws = sorted(v for rep in range(40) for v in [ratio([own[draw(rep, i, n)] for i in range(n)])] if v is not None) if n > 1 else []
        at = lambda q: pytest.approx(draws[int((len(draws) - 1) * q)]) if draws else None  # noqa: E731, B023
        whole = ratio(own)
        assert got[k] == (n, None if whole is None else pytest.approx(whole), at(0.025), at(0.975), len(draws))
