"""The whole segment report in long form, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import history, labels, report
from tidemark.operators.stats import COST_GRID
from tidemark.sources import projections

from .oracle import _SEGMENTS, _return, _vol, BOUNDS, MARKED, MIDS, OBS, SECOND, SIGNALS, STEPS, TRADES, _flow_1s, _label, with_

_HORIZONS = {"500ms": SECOND // 2, "1s": SECOND}


def segment_report_details(spark: SparkSession, d: str) -> DataFrame:
    """Per symbol and day: effective counts, bins, autocorrelations, regimes, costs, signal rules and a comparison."""
    obs = projections.observations(spark, d)
    mids = projections.mids(obs)
    # the flow comes first and is carried along: joined to the labels, it would have both sides' windows run again
    rows = history.trade_flow(mids, projections.trades(obs), {"1s": SECOND}).select(*mids.columns, F.col("imbalance_1s").alias("trade_imbalance_1s"))
    rows = history.realized_volatility(history.backward_returns(rows, {"1s": SECOND}), {"5s": 5 * SECOND})
    rows = labels.forward_labels(rows, projections.boundaries(obs), _HORIZONS, ())
    x = F.col("x")
    rows = rows.withColumns({
        "segment": F.date_format("ts", "yyyy-MM-dd"), "realized_volatility_5s": F.round("realized_volatility_5s", 9), "mid_price": F.col("price"), "spread_bps": F.lit(1.0) + F.col("k") / 100,
        "microprice_offset_bps": x / F.lit(10.0), "imbalance_l1": x, "imbalance_l5": x,
    })
    out = report.segment_details(rows, ["x", "return_1s"], _HORIZONS, ["x"], "realized_volatility_5s")
    return out.withColumn("value", F.round("value", 6) + F.lit(0.0))


_G = "symbol, segment, feature, horizon"
_CORR = "CASE WHEN count(*) >= 2 AND var_pop(x) > 0 AND var_pop(y) > 0 THEN covar_pop(x, y) / (sqrt(var_pop(x)) * sqrt(var_pop(y))) END"
_costs = ", ".join(f"('{c}', {c})" for c in COST_GRID)


def _acf(name: str, of: str, value: str, table: str) -> str:
    lags = " UNION ALL ".join(
        f"SELECT a.symbol, a.segment, a.{of}, '{m}' AS item, a.{value} AS x, b.{value} AS y FROM (SELECT *, monotonic_ns - {m * 10**6} AS due FROM {table}) a ASOF JOIN {table} b ON a.symbol = b.symbol AND a.segment = b.segment AND a.{of} = b.{of} AND a.due >= b.monotonic_ns WHERE b.monotonic_ns >= a.monotonic_ns - {m * 10**6 + 150_000_000}"
        for m in report.LAGS_MS
    )
    return f"{name} AS (SELECT symbol, segment, {of}, item, count(*) AS n, {_CORR} AS value FROM ({lags}) WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL)"


_PARTS = f"""sv AS MATERIALIZED (SELECT v.symbol, v.segment, v.capture_seq, v.monotonic_ns, f.feature, f.x FROM v JOIN r_1s a USING (capture_seq), LATERAL (SELECT 'x' AS feature, v.x AS x UNION ALL SELECT 'return_1s', a.v) f),
yv AS MATERIALIZED (SELECT v.symbol, v.segment, v.capture_seq, v.monotonic_ns, h.horizon, l.y FROM v, (VALUES ('500ms'), ('1s')) h(horizon) LEFT JOIN labs l ON l.capture_seq = v.capture_seq AND l.horizon = h.horizon),
{_acf('sacf', 'feature', 'x', 'sv')}, {_acf('racf', 'horizon', 'y', 'yv')},
ap AS MATERIALIZED (SELECT p.*, row_number() OVER (PARTITION BY p.symbol, p.segment, p.feature, p.horizon ORDER BY p.capture_seq) AS i, count(*) OVER (PARTITION BY p.symbol, p.segment, p.feature, p.horizon) AS n FROM pairs p JOIN chain c ON c.horizon = p.horizon AND c.capture_seq = p.capture_seq),
es AS MATERIALIZED (SELECT symbol, segment, feature, horizon, i, n, s.of_, s.v FROM ap, LATERAL (SELECT 'x' AS of_, ap.x AS v UNION ALL SELECT 'y', ap.y) s),
rho AS (SELECT {', '.join('p.' + c for c in _G.split(', '))}, p.of_, k.k, CASE WHEN count(*) >= 2 AND var_pop(p.v) > 0 AND var_pop(q.v) > 0 THEN covar_pop(p.v, q.v) / (sqrt(var_pop(p.v)) * sqrt(var_pop(q.v))) ELSE 0 END AS rho FROM range(1, 51) k(k), es p JOIN es q ON p.symbol = q.symbol AND p.segment = q.segment AND p.feature = q.feature AND p.horizon = q.horizon AND p.of_ = q.of_ AND p.i = q.i + k.k WHERE k.k < p.n // 3 GROUP BY ALL),
stop AS (SELECT {_G}, of_, min(k) FILTER (rho <= 0) AS stop FROM rho GROUP BY ALL), tot AS (SELECT {_G}, of_, sum(rho) AS total FROM rho JOIN stop USING ({_G}, of_) WHERE stop IS NULL OR k < stop GROUP BY ALL),
ess AS (SELECT {_G}, max(n) AS n, min(CASE WHEN n < 3 THEN n WHEN va = 0 THEN 1 ELSE greatest(1.0, least(CAST(n AS DOUBLE), n / (1 + 2 * coalesce(total, 0)))) END) AS value FROM (SELECT {_G}, of_, count(*) AS n, var_pop(v) AS va FROM es GROUP BY ALL) LEFT JOIN tot USING ({_G}, of_) GROUP BY {_G}),
kk AS (SELECT *, (row_number() OVER (PARTITION BY symbol, segment, feature, horizon ORDER BY x, capture_seq) * 10 - 1) // count(*) OVER (PARTITION BY symbol, segment, feature, horizon) AS bin FROM pairs),
bins AS (SELECT {_G}, bin, count(*) AS n, avg(y) AS m, stddev_samp(y) / sqrt(count(*)) AS e FROM kk GROUP BY ALL),
vv AS MATERIALIZED (SELECT v.symbol, v.segment, v.capture_seq, round(w.v, 9) AS vol FROM v JOIN v_5s w USING (capture_seq)),
vr AS (SELECT symbol, segment, vol, row_number() OVER (PARTITION BY symbol, segment ORDER BY vol) AS rn, count(*) OVER (PARTITION BY symbol, segment) AS n FROM vv WHERE vol IS NOT NULL),
cut AS (SELECT symbol, segment, max(CASE WHEN rn = (n - 1) // 3 + 1 THEN vol END) AS c0, max(CASE WHEN rn = (2 * (n - 1)) // 3 + 1 THEN vol END) AS c1 FROM vr GROUP BY ALL),
rg AS MATERIALIZED (SELECT vv.*, CASE WHEN vol <= c0 THEN 'LOW' WHEN vol <= c1 THEN 'MEDIUM' ELSE 'HIGH' END AS regime FROM vv JOIN cut USING (symbol, segment) WHERE vol IS NOT NULL),
edge AS (SELECT {_G}, count(CASE WHEN abs(x) >= 0.6 THEN 1 END) AS n, avg(CASE WHEN x >= 0.6 THEN y WHEN x <= -0.6 THEN -y END) * 10000 AS edge FROM pairs WHERE feature = 'x' GROUP BY ALL),
strat AS (SELECT y.symbol, y.segment, y.horizon, f.strategy, count(y.y) AS n, avg(CASE WHEN f.side = 'LONG' THEN y.y ELSE -y.y END) * 10000 AS edge FROM yv y JOIN fired f USING (capture_seq) GROUP BY ALL),
allrows AS (SELECT m.*, strftime(ts, '%Y-%m-%d') AS segment, 1.0 + k / 100 AS spread FROM mids m),
med AS (SELECT symbol, segment, 'spread_bps' AS of_, list_sort(list(CAST(spread AS DOUBLE))) AS l FROM allrows GROUP BY ALL UNION ALL SELECT symbol, segment, 'realized_volatility_5s', list_sort(list(vol)) FROM vv WHERE vol IS NOT NULL GROUP BY ALL),
same AS (SELECT symbol, segment, count(*) AS n, count(CASE WHEN feature_valid THEN 1 END) AS valid, count(CASE WHEN price = prev THEN 1 END) AS same FROM (SELECT *, lag(price) OVER (PARTITION BY symbol, segment ORDER BY capture_seq) AS prev FROM allrows) GROUP BY ALL),
found AS (
  SELECT {_G}, 'effective' AS part, NULL AS item, n, CAST(value AS DOUBLE) AS value FROM ess
  UNION ALL SELECT {_G}, 'bin_mean', CAST(bin AS VARCHAR), n, m FROM bins UNION ALL SELECT {_G}, 'bin_error', CAST(bin AS VARCHAR), n, e FROM bins
  UNION ALL SELECT symbol, segment, feature, NULL, 'signal_acf', item, n, value FROM sacf UNION ALL SELECT symbol, segment, NULL, horizon, 'return_acf', item, n, value FROM racf
  UNION ALL SELECT symbol, segment, NULL, NULL, 'regime_cut', regime, count(*), max(vol) FROM rg WHERE regime <> 'HIGH' GROUP BY symbol, segment, regime
  UNION ALL SELECT p.symbol, p.segment, p.feature, p.horizon, 'regime', r.regime, count(*), {_CORR} FROM pairs p JOIN rg r USING (capture_seq) GROUP BY p.symbol, p.segment, p.feature, p.horizon, r.regime
  UNION ALL SELECT {_G}, 'edge_net', c.name, n, edge - c.cost FROM edge, (VALUES {_costs}) c(name, cost) WHERE n > 0
  UNION ALL SELECT symbol, segment, NULL, horizon, 'strategy_net', strategy || ' ' || c.name, n, edge - c.cost FROM strat, (VALUES {_costs}) c(name, cost) WHERE n > 0
  UNION ALL SELECT symbol, segment, NULL, NULL, 'comparison', 'median_' || of_, len(l), (l[(len(l) - 1) // 2 + 1] + l[len(l) // 2 + 1]) / 2 FROM med
  UNION ALL SELECT symbol, segment, NULL, NULL, 'comparison', 'p95_spread_bps', len(l), l[CAST(floor((len(l) - 1) * 0.95) AS INT) + 1] FROM med WHERE of_ = 'spread_bps'
  UNION ALL SELECT symbol, segment, NULL, NULL, 'comparison', 'valid', n, valid FROM same UNION ALL SELECT symbol, segment, NULL, NULL, 'comparison', 'unchanged_fraction', n, same / greatest(1, n - 1) FROM same
)"""
_CTES = with_(OBS, MIDS, TRADES, BOUNDS, MARKED, *map(_label, _HORIZONS), _return("1s", SECOND), STEPS, _vol("5s", 5 * SECOND), _flow_1s, SIGNALS.strip(), _SEGMENTS, _PARTS).replace("WITH ", "WITH RECURSIVE ", 1)

QUERIES = {"segment_report_details": segment_report_details}
SQL = {"segment_report_details": f"{_CTES} SELECT 'S0' AS capture_session_id, symbol, segment, feature, horizon, part, item, CAST(n AS BIGINT) AS n, round(CAST(value AS DOUBLE), 6) + 0.0 AS value FROM found"}
