"""What the whole report reads and computes: nothing large twice."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import series, signals, stats
from tidemark.plans import registry
from tidemark.session import release, shared_table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def ranked_columns(monkeypatch):
    """The columns of the tables that are written for ranks."""
    seen = []

    def noted(df, name):
        if name == "ranked":
            seen.append(set(df.columns))
        return shared_table(df, name)

    monkeypatch.setattr(series, "shared_table", noted)
    return seen


def test_the_report_ends_in_tables(spark):
    """Spaced rows, bins and medians are read by several parts and aren't made again for each."""
    plan = registry.QUERIES["segment_report_details"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan


def test_ranks_take_along_only_what_is_asked_of_them(spark, ranked_columns):
    rows = spark.range(40).select(F.lit("A").alias("symbol"), F.col("id").alias("seq"), (F.col("id") % 7 * 1.0).alias("x"), F.col("id").cast("double").alias("y"), F.lit("long").alias("other"))
    assert stats.quantile_bins(rows, ["symbol"], "seq", bins=4).agg(F.sum("count")).first()[0] == 40
    stats.volatility_regimes(rows, ["symbol"], "x")
    assert ranked_columns and all("other" not in c for c in ranked_columns)


def test_signals_carry_columns(spark):
    rows = spark.createDataFrame([("S", "A", 1, 5, True, 0.7, "d")], "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint, feature_valid boolean, f double, segment string")
    assert [r.segment for r in signals.all_signals(rows, (signals.Rule("r", {"f": 0.6}, "first"),), ("segment",)).collect()] == ["d"]


@pytest.fixture(autouse=True, scope="module")
def released(spark):
    yield
    release(spark)
