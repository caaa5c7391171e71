"""Queries of scans over whole series, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import spacing, stats
from tidemark.sources import projections
from tidemark.streaming import windows

from . import queries
from .oracle import OBS, SECOND, _pairs, r, with_


def spacing_gap_free(spark: SparkSession, d: str) -> DataFrame:
    """One series on a jittered grid of 100 ms without gaps: rows at least 1 s and 10 s apart."""
    obs = projections.observations(spark, d)
    grid = obs.select("capture_session_id", "capture_seq", (F.col("capture_seq") * 100_000_000 + F.col("k") * 1_000_000).alias("monotonic_ns"))
    rows = None
    for name, ns in (("1s", SECOND), ("10s", 10 * SECOND)):
        own = spacing.non_overlapping(grid, ns, ["capture_session_id"], chunk_ns=60 * SECOND, group_chunks=16).withColumn("horizon", F.lit(name))
        rows = own if rows is None else rows.unionByName(own)
    return rows


def session_islands(spark: SparkSession, d: str) -> DataFrame:
    """Stretches of sign-ups of a series that are at most 3 s apart, as session windows."""
    return windows.sessions(projections.observations(spark, d).where("event_type = 'signup'"))


def bootstrap_fixed_draws(spark: SparkSession, d: str) -> DataFrame:
    """Block bootstrap of the return at strong signals, less the one at weak ones, with draws by arithmetic."""
    blocks = stats.block_sums(stats.complete(queries._pairs(spark, d)), ["symbol"])
    draw = lambda rep, place, n: F.pmod(rep * 7919 + place * 104729 + rep * place * 31, n)
    out = stats.resampled(blocks, ["symbol"], 60, True, draw)
    return out.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("estimate", "low", "high")})


QUERIES = {"bootstrap_fixed_draws": bootstrap_fixed_draws, "spacing_gap_free": spacing_gap_free, "session_islands": session_islands}
SQL = {
    "bootstrap_fixed_draws": f"""{with_(*_pairs())}, f AS (SELECT symbol, min(monotonic_ns) AS first FROM pairs WHERE y IS NOT NULL GROUP BY symbol),
        b AS MATERIALIZED (SELECT symbol, (monotonic_ns - first) // 10000000000 AS block, coalesce(sum(CASE WHEN x >= 0.6 THEN y * 10000 END), 0) AS hs, count(CASE WHEN x >= 0.6 THEN 1 END) AS hc, coalesce(sum(CASE WHEN x <= -0.6 THEN y * 10000 END), 0) AS ls, count(CASE WHEN x <= -0.6 THEN 1 END) AS lc FROM pairs JOIN f USING (symbol) WHERE y IS NOT NULL GROUP BY ALL),
        p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY block) - 1 AS place, count(*) OVER (PARTITION BY symbol) AS n FROM b),
        picks AS (SELECT p.symbol, r.r, (r.r * 7919 + p.place * 104729 + r.r * p.place * 31) % p.n AS place FROM p, range(60) r(r)),
        v AS (SELECT k.symbol, k.r, CASE WHEN sum(p.hc) > 0 AND sum(p.lc) > 0 THEN sum(p.hs) / sum(p.hc) - sum(p.ls) / sum(p.lc) END AS v FROM picks k JOIN p USING (symbol, place) GROUP BY ALL),
        l AS (SELECT symbol, list_sort(list(v)) AS l FROM v WHERE v IS NOT NULL GROUP BY symbol)
        SELECT symbol, count(*) AS block_count, {r('CASE WHEN sum(hc) > 0 AND sum(lc) > 0 THEN sum(hs) / sum(hc) - sum(ls) / sum(lc) END', 'estimate', 6)}, {r('any_value(l[CAST(floor((len(l) - 1) * 0.025) AS INT) + 1])', 'low', 6)}, {r('any_value(l[CAST(floor((len(l) - 1) * 0.975) AS INT) + 1])', 'high', 6)}, CAST(any_value(len(l)) AS BIGINT) AS draws FROM p JOIN l USING (symbol) GROUP BY symbol""",
    "session_islands": f"""{with_(OBS)}, marked AS (SELECT *, CASE WHEN monotonic_ns // 1000 - lag(monotonic_ns // 1000) OVER w <= 3000000 THEN 0 ELSE 1 END AS fresh FROM obs WHERE event_type = 'signup' WINDOW w AS (PARTITION BY symbol ORDER BY monotonic_ns)),
        islands AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY monotonic_ns ROWS UNBOUNDED PRECEDING) AS island FROM marked)
        SELECT capture_session_id, symbol, min(monotonic_ns) AS start_ns, max(monotonic_ns) AS end_ns, min(capture_seq) AS first_seq, max(capture_seq) AS last_seq, count(*) AS rows FROM islands GROUP BY capture_session_id, symbol, island""",
    "spacing_gap_free": f"""{with_(OBS).replace("WITH ", "WITH RECURSIVE ")}, grid AS MATERIALIZED (SELECT capture_session_id, capture_seq, capture_seq * 100000000 + k * 1000000 AS monotonic_ns FROM obs),
        due AS MATERIALIZED (SELECT h.horizon, g.capture_seq, g.monotonic_ns + h.ns AS due FROM grid g, (VALUES ('1s', 1000000000), ('10s', 10000000000)) h(horizon, ns)),
        next_ AS MATERIALIZED (SELECT a.horizon, a.capture_seq, b.capture_seq AS next_seq FROM due a ASOF LEFT JOIN grid b ON a.due <= b.monotonic_ns),
        chain AS (SELECT horizon, min(capture_seq) AS capture_seq FROM due GROUP BY horizon UNION ALL SELECT n.horizon, n.next_seq FROM chain c JOIN next_ n ON n.horizon = c.horizon AND n.capture_seq = c.capture_seq WHERE n.next_seq IS NOT NULL)
        SELECT g.*, c.horizon FROM chain c JOIN grid g USING (capture_seq)""",
}
