"""Dense series: frames that move one end only, and rows of one instant."""

from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators import history, labels, signals, stats
from tidemark.plans import registry
from tidemark.session import release

SMALL = "/root/testdata/sf0.001"
#: A frame with two ends in reach of a row is walked again for each row.
TWO_ENDED = re.compile(r"specifiedwindowframe\(rangeframe, -?\d", re.IGNORECASE)
ROWS = "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint, price double, feature_valid boolean"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["returns_backward", "realized_volatility", "trade_flow", "forward_labels", "label_excursions", "civil_range_labels", "autocorrelation_grid", "nearest_rows", "feature_engine"])
def test_no_frame_is_walked_again_for_each_row(spark, name):
    assert not TWO_ENDED.search(plan(registry.QUERIES[name](spark, SMALL)))


def test_a_dense_series_is_many_chunks(spark):
    """Ten minutes of a series are more than one group of rows."""
    rows = spark.range(600).select(F.lit("S").alias("capture_session_id"), F.lit("A").alias("symbol"), F.col("id").alias("capture_seq"), (F.col("id") * 1_000_000_000).alias("monotonic_ns"))
    assert history.chunked(rows, 0, 0).select("chunk").distinct().count() >= 10


def copied(tmp_path, times):
    """The small tables with every event ``times`` times, at the same instants."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT event_id + i * (SELECT max(event_id) + 1 FROM '{SMALL}/events.parquet') AS event_id, * EXCLUDE (event_id, i) FROM '{SMALL}/events.parquet', range({times}) r(i)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    return con


def test_join_of_features_and_labels_keeps_rows_of_one_instant_apart(spark, tmp_path):
    con = copied(tmp_path, 3)
    got = registry.QUERIES["feature_label_join"](spark, str(tmp_path))
    assert got.count() == con.execute("SELECT count(*) FROM events WHERE event_type <> 'error'").fetchone()[0]


@pytest.mark.parametrize("name", ["soak_gates", "feature_label_join", "forward_labels"])
def test_rows_of_one_instant_leave_nothing_to_chance(spark, tmp_path, name):
    """Query and SQL agree on events that come in threes an instant, with different values, numbered in the order of time."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT event_id * 3 + i AS event_id, ts, user_id, event_type, value + (i * 7 + event_id) % 5 AS value, props FROM '{SMALL}/events.parquet', range(3) r(i)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    registry.QUERIES[name](spark, str(tmp_path)).write.parquet(f"{tmp_path}/got")
    con.execute(f"CREATE TABLE want AS {registry.ORACLE_SQL[name]}")
    names = ", ".join(r[0] for r in con.execute("DESCRIBE want").fetchall())
    for a, b in ((f"'{tmp_path}/got/*.parquet'", "want"), ("want", f"'{tmp_path}/got/*.parquet'")):
        assert con.execute(f"SELECT {names} FROM {a} EXCEPT ALL SELECT {names} FROM {b}").fetchall() == []


def test_the_target_is_the_first_captured_row_of_its_instant(spark):
    rows = [("S", "A", 1, 0, 100.0, True), ("S", "A", 4, 10**9, 130.0, True), ("S", "A", 2, 10**9, 110.0, True), ("S", "A", 3, 10**9, 120.0, True)]
    df = spark.createDataFrame(rows, ROWS)
    got = labels.forward_labels(df, None, {"1s": 10**9}, ("1s",)).where("capture_seq = 1").select(F.exp("future_return_1s").alias("r")).collect()
    assert got[0].r == pytest.approx(1.1)


@pytest.mark.parametrize("start", [0, 59_999_999_000, -7_000])
def test_excursions_cross_the_ends_of_stretches(spark, start):
    """Against brute force, with several rows an instant and an horizon whose stretches begin between rows."""
    price = lambda i: 100 + (i * 7919) % 101
    rows = [("S", "A", i, start + (i // 2) * 700, float(price(i)), True) for i in range(60)]
    h = 3_000
    df = spark.createDataFrame(rows, ROWS)
    got = {r.capture_seq: r for r in labels.forward_labels(df, None, {"1s": h}, ("1s",)).withColumns({"up": F.exp(F.col("future_max_up_bps_1s") / 10000) * F.col("price"), "down": F.exp(F.col("future_max_down_bps_1s") / 10000) * F.col("price")}).collect()}
    for _, _, seq, ns, _, _ in rows:
        later = [r for r in rows if r[3] >= ns + h]
        if not later:
            assert got[seq].up is None
            continue
        target = min(later, key=lambda r: (r[3], r[2]))
        path = [r[4] for r in rows if ns < r[3] < ns + h] + [target[4]]
        assert (got[seq].up, got[seq].down) == (pytest.approx(max(path)), pytest.approx(min(path)))


def test_autocorrelation_takes_the_last_captured_row_of_an_instant(spark):
    rows = [("A", 3, 0, 3.0), ("A", 1, 0, 9.0), ("A", 2, 0, 9.0), ("A", 4, 10**9, 1.0), ("A", 5, 2 * 10**9, 5.0)]
    df = spark.createDataFrame(rows, "symbol string, capture_seq bigint, monotonic_ns bigint, x double")
    got = stats.autocorrelation(df, ["symbol"], (1000,)).collect()[0]
    # pairs (1, 3) and (5, 1)
    assert (got.n, got.acf) == (2, pytest.approx(-1.0))


@pytest.mark.parametrize("force_close", [False, True])
def test_shadow_positions_on_a_dense_series(spark, force_close):
    """Against a scan of the rows, without a gap in the series and with rows of one instant; no Python group holds a series."""
    rule = signals.Rule("r", {"f": 0.6}, "first")
    rows = [("S", "A", i, (i // 3) * 100, float(100 + (i * 37) % 23), 1.0 + i, True, ((i * 13) % 11 - 5) / 5.0) for i in range(120)]
    df = spark.createDataFrame(rows, "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint, mid_price double, spread_bps double, feature_valid boolean, f double")
    want, i = [], 0
    while i < len(rows):
        if abs(rows[i][7]) < 0.6:
            i += 1
            continue
        e = next((k for k in range(i + 1, len(rows)) if rows[k][3] >= rows[i][3] + 250), None)
        if e is None and not force_close:
            break
        x = len(rows) - 1 if e is None else e
        path = [r[4] for r in rows[i : x + 1]]
        want.append(("LONG" if rows[i][7] > 0 else "SHORT", rows[i][3], rows[x][3], rows[i][4], rows[x][4], rows[i][5], rows[x][5], max(path), min(path), "TIME_STOP" if e is not None else "END_OF_DATA"))
        if e is None:
            break
        i = e
    made = signals.shadow_positions(df, rule, 250, force_close=force_close)
    names = ["side", "entry_ns", "exit_ns", "entry_mid", "exit_mid", "entry_spread_bps", "exit_spread_bps", "path_max", "path_min", "exit_reason"]
    assert sorted(map(tuple, made.select(*names).collect()), key=lambda r: r[5]) == want
    assert "island" not in plan(made)


@pytest.fixture(autouse=True, scope="module")
def released(spark):
    yield
    release(spark)
