"""Queries over records: nested differences, nearest rows, feature tables by version, cumulative distributions; and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import distributions, nearest, nested
from tidemark.session import own_folder
from tidemark.sources import features, projections
from tidemark.sources.projections import KEYS

from .oracle import OBS, SECOND, r, with_


def nested_differences(spark: SparkSession, d: str) -> DataFrame:
    """Nested records against a copy that is off in a level, a map entry, a reason, a struct or a whole row: rows and largest size by path."""
    obs = projections.observations(spark, d)
    x, seq = F.col("qty").cast("double"), F.col("capture_seq")

    def record(off) -> DataFrame:
        level = lambda i, o: F.struct((F.col("price") + i + o).cast("decimal(18,8)").alias("price"), (x / (i + 1)).alias("share"))
        return obs.select(
            *KEYS, "capture_seq",
            F.struct(F.array(level(0, off(11, 1, 0)), level(1, 0)).alias("levels"), F.when(off(13, True, False), F.lit(None)).otherwise(F.col("price")).alias("mid")).alias("book"),
            F.create_map(F.lit("1s"), x + off(17, 0.5, 0.0), F.lit("5s"), x + off(19, 1e-13, 0.0)).alias("flow"),
            F.when(off(23, True, False), F.array(F.lit("late"))).otherwise(F.array().cast("array<string>")).alias("reasons"),
        )

    actual = record(lambda n, wrong, right: F.lit(right))
    recorded = record(lambda n, wrong, right: F.when(seq % n == 0, wrong).otherwise(right)).where("capture_seq % 101 <> 0")
    out = nested.by_path(nested.nested_differences(actual, recorded, [*KEYS, "capture_seq"]))
    return out.withColumn("largest", F.round("largest", 6))


def nearest_rows(spark: SparkSession, d: str) -> DataFrame:
    """For each error of a series the nearest sign-up within half a second of the clock."""
    obs = projections.observations(spark, d)
    targets = obs.where("event_type = 'error'").select(*KEYS, "capture_seq", "monotonic_ns")
    rows = obs.where("event_type = 'signup'").select(*KEYS, "capture_seq", "monotonic_ns", F.col("capture_seq").alias("near_seq"), F.col("k").alias("near_k"))
    return nearest.nearest(targets, rows, SECOND // 2, ["near_seq", "near_k"])


def feature_scan(spark: SparkSession, d: str) -> DataFrame:
    """Features recorded in both versions, read back as nested values, looked up by name."""
    obs = projections.observations(spark, d).where("event_type <> 'error'")
    folder = f"{own_folder(spark)}/features-{uuid.uuid4().hex}"
    text = F.col("price").cast("string")
    for version in features.VERSIONS:
        made = {"schema_version": F.lit(version), "dataset_version": F.lit(1), "capture_session_id": F.col("capture_session_id"), "capture_seq": F.col("capture_seq"), "symbol": F.col("symbol"), "monotonic_ns": F.col("monotonic_ns")}
        made |= {"best_bid_price": text, "mid_price": text, "spread_bps": F.col("k") / 10, "return_1s": F.col("k") / 100, "realized_volatility_5s": F.col("k") / 1000, "feature_valid": F.col("k") != 99, "invalid_reasons": F.when(F.col("k") == 99, F.array(F.lit("STALE_BOOK"))).otherwise(F.array())}
        for i, n in enumerate(features.DEPTHS):
            made |= {f"bid_volume_l{n}": (F.col("k") + i).cast("string"), f"ask_volume_l{n}": F.col("k").cast("string"), f"book_imbalance_l{n}": (F.col("k") - n) / 128}
        for n in features.WINDOWS:
            some = F.col("k") % n == 0
            made |= {f"total_volume_{n}s": F.when(some, F.col("qty").cast("string")), f"{'aggregate_' if version == 1 else ''}trade_event_count_{n}s": F.when(some, F.col("k") + n), f"trade_imbalance_{n}s": F.when(some, F.col("k") / 256)}
        columns = [made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in features.feature_schema(version)]
        obs.where(F.col("capture_seq") % 2 == version - 1).select(*columns).write.parquet(f"{folder}/{version}")
    scanned = features.feature_scan(spark, {v: [f"{folder}/{v}"] for v in features.VERSIONS})
    found = [features.feature_value(n) for n in ("imbalance_l5", "trade_imbalance_5s", "return_1s", "rv_5s")]
    return scanned.select(
        *KEYS, "capture_seq", F.col("schema_version").cast("int").alias("version"), F.col("book.mid_price").cast("double").alias("mid_price"), *found, F.col("flow")[5]["available"].alias("available"),
        F.col("flow")[5]["trade_event_count"].alias("trades"), F.col("depth")[10]["bid_volume"].cast("double").alias("bid_volume_l10"), F.array_join("invalid_reasons", ",").alias("reasons"),
    )


def latency_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    """Distribution of trade sizes of a series after each 100 trades, quantiles over the last 250."""
    out = distributions.cumulative(projections.trades(projections.observations(spark, d)), "qty", every=100, capacity=250)
    return out.withColumns({c: F.round(c, 9) + F.lit(0.0) for c in ("mean", "maximum", "p50", "p95", "p99")})


QUERIES = {"nested_differences": nested_differences, "nearest_rows": nearest_rows, "feature_scan": feature_scan, "latency_checkpoints": latency_checkpoints}
SQL = {
    "nested_differences": f"""{with_(OBS)}, f AS (SELECT capture_seq AS s, capture_seq % 101 = 0 AS gone FROM obs), d AS (
        SELECT 'missing' AS path, NULL AS size FROM f WHERE gone UNION ALL SELECT 'book.levels[].price', NULL FROM f WHERE NOT gone AND s % 11 = 0 UNION ALL SELECT 'book.mid', NULL FROM f WHERE NOT gone AND s % 13 = 0
        UNION ALL SELECT 'flow.1s', 0.5 FROM f WHERE NOT gone AND s % 17 = 0 UNION ALL SELECT 'reasons', NULL FROM f WHERE NOT gone AND s % 23 = 0)
        SELECT path, count(*) AS rows, round(CAST(max(size) AS DOUBLE), 6) AS largest FROM d GROUP BY path""",
    "nearest_rows": f"""{with_(OBS)}, s AS MATERIALIZED (SELECT symbol, capture_seq AS near_seq, monotonic_ns AS near_ns, k AS near_k FROM obs WHERE event_type = 'signup'), t AS MATERIALIZED (SELECT capture_session_id, symbol, capture_seq, monotonic_ns FROM obs WHERE event_type = 'error'),
        pairs AS (SELECT t.*, s.* EXCLUDE (symbol), abs(s.near_ns - t.monotonic_ns) AS away FROM t LEFT JOIN s ON s.symbol = t.symbol AND s.near_ns BETWEEN t.monotonic_ns - 500000000 AND t.monotonic_ns + 500000000)
        SELECT capture_session_id, symbol, capture_seq, monotonic_ns, near_ns, near_seq, near_k FROM (SELECT *, row_number() OVER (PARTITION BY capture_seq ORDER BY away, near_ns, near_seq) AS rn FROM pairs) WHERE rn = 1""",
    "feature_scan": f"""{with_(OBS)} SELECT capture_session_id, symbol, capture_seq, CAST(capture_seq % 2 + 1 AS INT) AS version, CAST(price AS DOUBLE) AS mid_price, (k - 5) / CAST(128 AS DOUBLE) AS imbalance_l5, CASE WHEN k % 5 = 0 THEN k / CAST(256 AS DOUBLE) END AS trade_imbalance_5s,
        k / CAST(100 AS DOUBLE) AS return_1s, k / CAST(1000 AS DOUBLE) AS rv_5s, k % 5 = 0 AS available, CASE WHEN k % 5 = 0 THEN CAST(k + 5 AS BIGINT) END AS trades, CAST(k + 2 AS DOUBLE) AS bid_volume_l10, CASE WHEN k = 99 THEN 'STALE_BOOK' ELSE '' END AS reasons FROM obs WHERE event_type <> 'error'""",
    "latency_checkpoints": f"""{with_(OBS)}, t AS MATERIALIZED (SELECT capture_session_id, symbol, capture_seq, CAST(qty AS DOUBLE) AS v, row_number() OVER (PARTITION BY symbol ORDER BY capture_seq) AS place FROM obs WHERE event_type IN ('click', 'view')),
        c AS (SELECT capture_session_id, symbol, (place - 1) // 100 AS checkpoint, max(place) AS n, max(capture_seq) AS last_seq FROM t GROUP BY ALL),
        a AS (SELECT c.*, avg(t.v) AS mean, max(t.v) AS maximum, list_sort(list(t.v) FILTER (t.place > c.n - 250)) AS l FROM c JOIN t ON t.symbol = c.symbol AND t.place <= c.n GROUP BY ALL)
        SELECT capture_session_id, symbol, checkpoint, last_seq, n AS count, CAST(len(l) AS BIGINT) AS retained, {r('mean', 'mean', 9)}, {r('maximum', 'maximum', 9)}, {r('(l[(len(l) - 1) // 2 + 1] + l[len(l) // 2 + 1]) / 2', 'p50', 9)},
        {r('l[CAST(floor((len(l) - 1) * 0.95) AS INT) + 1]', 'p95', 9)}, {r('l[CAST(floor((len(l) - 1) * 0.99) AS INT) + 1]', 'p99', 9)} FROM a""",
}
