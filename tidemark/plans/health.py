"""Queries of wire payloads, sampled health and gates, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import health, nearest
from tidemark.session import shared_table
from tidemark.sources import projections, schemas
from tidemark.sources.projections import KEYS

from .oracle import OBS, SECOND, r, with_


def wire_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON of four kinds, some wrapped, parsed again."""
    obs = projections.observations(spark, d).where("event_type <> 'error'")
    text = lambda c: F.col(c).cast("string")
    seq = F.col("capture_seq")
    common = {"E": seq * 1000, "T": seq * 1000 + 1, "s": F.lower("symbol")}
    levels = F.array(F.array(text("price"), text("qty")), F.array(text("qty"), F.lit("0")))
    own = {
        "aggTrade": {"a": seq, "p": text("price"), "q": text("qty"), "f": seq, "l": seq, "m": F.col("k") % 2 == 0}, "trade": {"t": seq, "p": text("price"), "q": F.when(F.col("k") % 10 == 0, "0").otherwise(text("qty")), "m": F.col("k") % 2 == 0},
        "bookTicker": {"u": seq, "b": text("qty"), "B": F.lit("1"), "a": text("price"), "A": F.lit("2")}, "depthUpdate": {"U": seq - 1, "u": seq, "pu": seq - 2, "b": levels, "a": F.array().cast("array<array<string>>")},
    }
    kinds = dict(zip(own, ("click", "view", "purchase", "signup"), strict=True))
    body = F.coalesce(*[F.when(F.col("event_type") == k, F.to_json(F.struct(F.lit(e).alias("e"), *[c.alias(n) for n, c in {**common, **own[e]}.items()]))) for e, k in kinds.items()])
    wire = obs.select("capture_seq", F.when(seq % 3 == 0, F.concat(F.lit('{"stream":"x","data":'), body, F.lit("}"))).otherwise(body).alias("value"))
    got = schemas.parse_wire(shared_table(wire, "wire"))
    return got.select(
        "capture_seq", "kind", "symbol", F.unix_millis("event_time").alias("event_ms"), F.col("price").cast("double").alias("price"), F.col("quantity").cast("double").alias("quantity"), "aggressor_side", "first_update_id", "final_update_id", "previous_final_update_id",
        F.col("best_bid_price").cast("double").alias("best_bid"), F.col("best_ask_quantity").cast("double").alias("best_ask_quantity"), F.size("bids").cast("int").alias("bid_levels"), F.get("bids", F.lit(0))["price"].cast("double").alias("first_bid"), F.size("asks").cast("int").alias("ask_levels"),
    )


def soak_gates(spark: SparkSession, d: str) -> DataFrame:
    """Sign-ups as resource samples of a run a series: late slopes, growth between checkpoints, worst rate, and the gate's decision."""
    obs = projections.observations(spark, d).where("event_type = 'signup'")
    samples = obs.select(*KEYS, "capture_seq", "monotonic_ns", (F.col("monotonic_ns") / 1e9).alias("t"), F.col("qty").cast("double").alias("rss"), F.col("capture_seq").alias("events"))
    slopes = health.late_slopes(samples, {"late": 100.0, "final": 50.0}, "t", "rss")
    ends = samples.groupBy(*KEYS).agg(F.max("monotonic_ns").alias("end_ns"))
    marks = ends.select(*KEYS, F.explode(F.array(*[F.struct(F.lit(n).alias("mark"), (F.col("end_ns") - n * 30 * SECOND).alias("monotonic_ns")) for n in (0, 1, 2)])).alias("m")).select(*KEYS, "m.*")
    near = nearest.nearest(marks, samples, SECOND, ["rss"]).groupBy(*KEYS).agg(*[F.max(F.when(F.col("mark") == n, F.col("rss"))).alias(f"rss_{n}") for n in (0, 1, 2)])
    worst = health.rates(samples, ["events"]).groupBy(*KEYS).agg(F.max("events_rate").alias("worst_rate"))
    out = slopes.join(near, KEYS).join(worst, KEYS).withColumns({"last_delta": F.col("rss_0") - F.col("rss_1"), "delta_before": F.col("rss_1") - F.col("rss_2")})
    gated = health.decided(
        out,
        {"rate": F.col("worst_rate") > 200_000, "short": F.col("last_x") < 8_000},
        {"late_slope": F.col("slope_late") > 0, "final_slope": F.col("slope_final") > 0, "acceleration": (F.col("last_delta") > 20) & (F.col("last_delta") > F.col("delta_before"))},
    )
    numbers = ["slope_late", "slope_final", "last_delta", "worst_rate"]
    return gated.select(*KEYS, *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in numbers], F.array_join("failure_reasons", ",").alias("failures"), F.array_join("warning_reasons", ",").alias("warnings"), "decision")


QUERIES = {"wire_payloads": wire_payloads, "soak_gates": soak_gates}
_near = " ".join(f"LEFT JOIN LATERAL (SELECT arg_min(rss, (abs(s.monotonic_ns - e.end_ns + {n * 30 * SECOND}), s.monotonic_ns, s.capture_seq)) AS rss_{n} FROM s WHERE s.symbol = e.symbol AND abs(s.monotonic_ns - e.end_ns + {n * 30 * SECOND}) <= 1000000000) n{n} ON true" for n in (0, 1, 2))
SQL = {
    "wire_payloads": f"""{with_(OBS)}, w AS (SELECT *, CASE event_type WHEN 'click' THEN 'aggTrade' WHEN 'view' THEN 'trade' WHEN 'purchase' THEN 'bookTicker' ELSE 'depthUpdate' END AS kind FROM obs WHERE event_type <> 'error')
        SELECT capture_seq, kind, symbol, capture_seq * 1000 AS event_ms, CASE WHEN kind IN ('aggTrade', 'trade') THEN CAST(price AS DOUBLE) END AS price, CASE WHEN kind IN ('aggTrade', 'trade') THEN CAST(qty AS DOUBLE) END AS quantity,
        CASE WHEN kind IN ('aggTrade', 'trade') THEN CASE WHEN k % 2 = 0 THEN 'SELL' ELSE 'BUY' END END AS aggressor_side, CASE WHEN kind = 'depthUpdate' THEN capture_seq - 1 END AS first_update_id, CASE WHEN kind IN ('bookTicker', 'depthUpdate') THEN capture_seq END AS final_update_id,
        CASE WHEN kind = 'depthUpdate' THEN capture_seq - 2 END AS previous_final_update_id, CASE WHEN kind = 'bookTicker' THEN CAST(qty AS DOUBLE) END AS best_bid, CASE WHEN kind = 'bookTicker' THEN CAST(2 AS DOUBLE) END AS best_ask_quantity,
        CASE WHEN kind = 'depthUpdate' THEN CAST(2 AS INT) END AS bid_levels, CASE WHEN kind = 'depthUpdate' THEN CAST(price AS DOUBLE) END AS first_bid, CASE WHEN kind = 'depthUpdate' THEN CAST(0 AS INT) END AS ask_levels FROM w WHERE NOT (kind = 'trade' AND (k % 10 = 0 OR qty <= 0))""",
    "soak_gates": f"""{with_(OBS)}, s AS MATERIALIZED (SELECT *, monotonic_ns / 1e9 AS t, CAST(qty AS DOUBLE) AS rss FROM obs WHERE event_type = 'signup'), e AS (SELECT capture_session_id, symbol, max(monotonic_ns) AS end_ns, max(t) AS last_t FROM s GROUP BY ALL),
        sl AS (SELECT symbol, CASE WHEN count(*) FILTER (s.t >= e.last_t - 100) >= 3 THEN regr_slope(rss, t) FILTER (s.t >= e.last_t - 100) END AS slope_late, CASE WHEN count(*) FILTER (s.t >= e.last_t - 50) >= 3 THEN regr_slope(rss, t) FILTER (s.t >= e.last_t - 50) END AS slope_final FROM s JOIN e USING (symbol) GROUP BY symbol),
        rt AS (SELECT symbol, max(rate) AS worst_rate FROM (SELECT symbol, CASE WHEN monotonic_ns > lag(monotonic_ns) OVER w THEN (capture_seq - lag(capture_seq) OVER w) / ((monotonic_ns - lag(monotonic_ns) OVER w) / 1e9) END AS rate FROM s WINDOW w AS (PARTITION BY symbol ORDER BY capture_seq)) GROUP BY symbol),
        j AS (SELECT *, rss_0 - rss_1 AS last_delta, rss_1 - rss_2 AS delta_before FROM e {_near} JOIN sl USING (symbol) JOIN rt USING (symbol)),
        g AS (SELECT *, concat_ws(',', CASE WHEN coalesce(worst_rate > 200000, true) THEN 'rate' END, CASE WHEN last_t < 8000 THEN 'short' END) AS failures, concat_ws(',', CASE WHEN coalesce(last_delta > 20 AND last_delta > delta_before, true) THEN 'acceleration' END, CASE WHEN coalesce(slope_final > 0, true) THEN 'final_slope' END, CASE WHEN coalesce(slope_late > 0, true) THEN 'late_slope' END) AS warnings FROM j)
        SELECT capture_session_id, symbol, {r('slope_late', 'slope_late', 6)}, {r('slope_final', 'slope_final', 6)}, {r('last_delta', 'last_delta', 6)}, {r('worst_rate', 'worst_rate', 6)}, failures, warnings, CASE WHEN failures <> '' THEN 'FAIL' WHEN warnings <> '' THEN 'WARNING' ELSE 'PASS' END AS decision FROM g""",
}
