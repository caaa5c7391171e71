"""The feature engine over an event stream with reconnects, resynchronisations and ties, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import engine
from tidemark.operators.history import RETURN_HORIZONS, WINDOWS
from tidemark.sources import projections
from tidemark.sources.projections import KEYS

from .oracle import OBS, r, with_

_COARSE = 20_000_000
_ROUNDED = ["mid_price", "spread_bps", *[f"return_{h}" for h in RETURN_HORIZONS], *[f"realized_volatility_{w}" for w in WINDOWS], "imbalance_1s", "vwap_5s", "book_age_ms", "trade_stream_age_ms"]


def engine_events(spark: SparkSession, d: str) -> DataFrame:
    """Purchases are books (some unhealthy, crossed or empty at the top), sign-ups ticks, clicks and views trades, errors the rest; on
    a clock of 20 ms, where instants have several rows."""
    obs = projections.observations(spark, d)
    k, error = F.col("k"), F.col("event_type") == "error"
    kind = F.when(error, F.when(k < 12, "connected").when(k < 14, "disconnected").when(k < 20, "invalidated").otherwise("activity")).when(F.col("event_type") == "purchase", "book").when(F.col("event_type") == "signup", "tick").otherwise("trade")
    rows = obs.withColumns({"kind": kind, "monotonic_ns": F.expr(f"monotonic_ns div {_COARSE} * {_COARSE}")})
    price = lambda c: (F.col("price") + c / 8).cast("decimal(18,8)")
    book = {
        "best_bid_price": price(-(k % 4)), "best_bid_quantity": (k % 9).cast("decimal(18,8)"), "best_ask_price": price(k % 5 - 1), "best_ask_quantity": (k % 7).cast("decimal(18,8)"), "resync_count": F.expr("capture_seq div 3000"),
        "healthy": k % 10 != 0, "receive_ns": F.when(k % 3 == 0, F.col("monotonic_ns")), "book_age_ms": (k / 10).cast("double"), "update_id": F.col("capture_seq"),
    }
    return rows.select(*KEYS, "capture_seq", "monotonic_ns", "kind", "price", "qty", F.when(F.col("event_type") == "click", "BUY").when(F.col("event_type") == "view", "SELL").alias("aggressor_side"), *[F.when(F.col("kind") == "book", v).alias(c) for c, v in book.items()])


def feature_engine(spark: SparkSession, d: str) -> DataFrame:
    out = engine.feature_engine(engine_events(spark, d), book_stale_ms=400, trade_stale_ms=300)
    out = out.select(*KEYS, "capture_seq", "monotonic_ns", "book_last_update_id", *_ROUNDED, "count_10s", "book_healthy", "trade_stream_healthy", "feature_valid", F.array_join("invalid_reasons", ",").alias("reasons"))
    return out.withColumns({c: F.round(F.col(c).cast("double"), 6) + F.lit(0.0) for c in _ROUNDED})


def _flow(seconds: int) -> str:
    return f"FILTER (e.monotonic_ns >= t.monotonic_ns - {seconds * 10**9})"


_returns = ", ".join(f"CASE WHEN now_ns <= ns - {h} THEN 0.0 ELSE ln(now / arg_max(p, o_ns) FILTER (o_ns <= ns - {h} AND o_ns >= now_ns - 15000000000)) END AS return_{n}" for n, h in RETURN_HORIZONS.items())
_vols = ", ".join(f"CASE WHEN count(p) FILTER (o_ns >= ns - {w}) >= 2 THEN sqrt(coalesce(sum(sq) FILTER (o_ns >= ns - {w} AND prev_ns >= ns - {w}), 0)) END AS realized_volatility_{n}" for n, w in WINDOWS.items())
_SQL = f"""ev AS MATERIALIZED (
  SELECT * REPLACE (monotonic_ns // {_COARSE} * {_COARSE} AS monotonic_ns), CASE WHEN event_type = 'error' THEN CASE WHEN k < 12 THEN 'connected' WHEN k < 14 THEN 'disconnected' WHEN k < 20 THEN 'invalidated' ELSE 'activity' END WHEN event_type = 'purchase' THEN 'book' WHEN event_type = 'signup' THEN 'tick' ELSE 'trade' END AS kind,
         price - (k % 4) / 8.0 AS bid, price + (k % 5 - 1) / 8.0 AS ask, k % 9 AS bq, k % 7 AS aq, capture_seq // 3000 AS gen, k % 10 <> 0 AS healthy FROM obs
), g AS (SELECT symbol, capture_seq, gen, lag(gen) OVER (PARTITION BY symbol ORDER BY capture_seq) AS prev_gen FROM ev WHERE kind = 'book'
), st AS MATERIALIZED (
  SELECT ev.*, sum(CASE WHEN kind IN ('disconnected', 'invalidated') OR (kind = 'book' AND (g.prev_gen IS NULL OR g.prev_gen <> g.gen OR NOT healthy)) THEN 1 ELSE 0 END) OVER w AS epoch, sum(CASE WHEN kind = 'disconnected' THEN 1 ELSE 0 END) OVER w AS connection,
         max(CASE WHEN kind = 'book' THEN capture_seq END) OVER w AS book_seq, max(CASE WHEN kind IN ('book', 'disconnected', 'invalidated') THEN capture_seq END) OVER w AS valid_seq, max(CASE WHEN kind IN ('connected', 'disconnected') THEN capture_seq END) OVER w AS con_seq, max(CASE WHEN kind IN ('connected', 'disconnected', 'trade', 'activity') THEN capture_seq END) OVER w AS act_seq
  FROM ev LEFT JOIN g USING (symbol, capture_seq) WINDOW w AS (PARTITION BY symbol ORDER BY capture_seq ROWS UNBOUNDED PRECEDING)
), t AS MATERIALIZED (
  SELECT s.capture_session_id, s.symbol, s.capture_seq, s.monotonic_ns, s.epoch, s.connection, b.capture_seq AS book_last_update_id, b.bid, b.ask, b.bq, b.aq, b.monotonic_ns AS b_ns, b.k AS b_k, v.kind = 'book' AND v.healthy AS valid, coalesce(c.kind = 'connected', false) AS connected, CASE WHEN a.kind <> 'disconnected' THEN (s.monotonic_ns - a.monotonic_ns) / 1e6 END AS idle
  FROM st s JOIN ev b ON b.capture_seq = s.book_seq LEFT JOIN ev v ON v.capture_seq = s.valid_seq LEFT JOIN ev c ON c.capture_seq = s.con_seq LEFT JOIN ev a ON a.capture_seq = s.act_seq WHERE s.kind = 'tick'
), o AS MATERIALIZED (
  SELECT t.capture_seq, t.monotonic_ns AS ns, e.monotonic_ns AS o_ns, arg_max(CAST(e.bid + e.ask AS DOUBLE) / 2, e.capture_seq) AS p FROM t JOIN st e ON e.symbol = t.symbol AND e.epoch = t.epoch AND e.kind = 'book' AND e.healthy AND e.capture_seq < t.capture_seq GROUP BY ALL
), p AS (SELECT *, power(ln(p / lag(p) OVER w), 2) AS sq, lag(o_ns) OVER w AS prev_ns, last_value(p) OVER x AS now, last_value(o_ns) OVER x AS now_ns FROM o WINDOW w AS (PARTITION BY capture_seq ORDER BY o_ns), x AS (PARTITION BY capture_seq ORDER BY o_ns ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), h AS (SELECT capture_seq, {_returns}, {_vols} FROM p GROUP BY capture_seq, ns, now, now_ns
), f AS (
  SELECT t.capture_seq, count(e.capture_seq) AS count_10s, coalesce(sum(CASE WHEN e.event_type = 'click' THEN e.qty END) {_flow(1)}, 0) AS buy, coalesce(sum(CASE WHEN e.event_type = 'view' THEN e.qty END) {_flow(1)}, 0) AS sell, CAST(sum(CAST(e.price AS DECIMAL(19,8)) * e.qty) {_flow(5)} AS DOUBLE) AS notional, CAST(sum(e.qty) {_flow(5)} AS DOUBLE) AS qty
  FROM t LEFT JOIN st e ON e.symbol = t.symbol AND e.connection = t.connection AND e.kind = 'trade' AND e.capture_seq < t.capture_seq AND e.monotonic_ns >= t.monotonic_ns - 10000000000 GROUP BY t.capture_seq
), j AS (SELECT *, connected AND coalesce(idle <= 300, false) AS streams, (monotonic_ns - b_ns) / 1e6 + CAST(b_k AS DOUBLE) / 10 AS age FROM t JOIN f USING (capture_seq) LEFT JOIN h USING (capture_seq))"""

QUERIES = {"feature_engine": feature_engine}
SQL = {
    "feature_engine": f"""{with_(OBS, _SQL)} SELECT capture_session_id, symbol, capture_seq, monotonic_ns, book_last_update_id, {r('CAST(bid + ask AS DOUBLE) / 2', 'mid_price', 6)}, {r('CASE WHEN bid + ask <> 0 THEN CAST(ask - bid AS DOUBLE) / (CAST(bid + ask AS DOUBLE) / 2) * 10000 END', 'spread_bps', 6)},
        {', '.join(r(c, c, 6) for c in _ROUNDED[2:-4])}, {r('CASE WHEN streams AND buy + sell > 0 THEN CAST(buy - sell AS DOUBLE) / CAST(buy + sell AS DOUBLE) END', 'imbalance_1s', 6)}, {r('CASE WHEN streams AND qty > 0 THEN notional / qty END', 'vwap_5s', 6)}, {r('age', 'book_age_ms', 6)}, {r('idle', 'trade_stream_age_ms', 6)},
        CASE WHEN streams THEN count_10s END AS count_10s, valid AND age <= 400 AS book_healthy, streams AS trade_stream_healthy, valid AND age <= 400 AND bid < ask AND bq > 0 AND aq > 0 AND streams AS feature_valid,
        concat_ws(',', CASE WHEN NOT valid THEN 'BOOK_UNHEALTHY' END, CASE WHEN age > 400 THEN 'BOOK_STALE' END, CASE WHEN bid >= ask THEN 'INVALID_SPREAD' END, CASE WHEN bq <= 0 OR aq <= 0 THEN 'INVALID_TOP_OF_BOOK' END, CASE WHEN NOT streams THEN 'TRADE_STREAM_UNHEALTHY' END) AS reasons FROM j""",
}
