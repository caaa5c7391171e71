"""DuckDB SQL with the results of the registered queries."""

from __future__ import annotations

SECOND = 1_000_000_000
HORIZONS = {"250ms": SECOND // 4, "500ms": SECOND // 2, "1s": SECOND, "2s": 2 * SECOND, "5s": 5 * SECOND, "10s": 10 * SECOND}
WINDOWS = {"1s": SECOND, "5s": 5 * SECOND, "10s": 10 * SECOND}

OBS = """obs AS (
  SELECT 'S0' AS capture_session_id, concat('SYM', CAST(user_id % 4 AS VARCHAR)) AS symbol, event_id AS capture_seq,
         ((epoch_us(ts) - 1704067200000000) * 1000) // 3600 AS monotonic_ns, event_type,
         CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(value AS DECIMAL(18,8)) AS qty,
         CAST(CAST(100 AS DECIMAL(18,8)) + CAST(value AS DECIMAL(18,8)) AS DECIMAL(18,8)) AS price, ts
  FROM events
)"""
MIDS = """mids AS (
  SELECT capture_session_id, symbol, capture_seq, monotonic_ns, price, CAST(price AS DOUBLE) AS p, qty, k, ts, k <> 99 AS feature_valid,
         (CAST(k AS DOUBLE) - CAST(49.5 AS DOUBLE)) / CAST(49.5 AS DOUBLE) AS x
  FROM obs WHERE event_type <> 'error'
)"""
TRADES = "trades AS (SELECT *, CASE WHEN event_type = 'click' THEN 'BUY' ELSE 'SELL' END AS side FROM obs WHERE event_type IN ('click', 'view'))"
BOUNDS = "bnd AS (SELECT symbol, monotonic_ns FROM obs WHERE event_type = 'error' AND k < 10)"
CLOCK = """clk AS (
  SELECT capture_session_id, symbol, capture_seq, monotonic_ns, CAST(k - 50 AS DOUBLE) AS offset_ms, CAST(qty AS DOUBLE) AS rtt_ms
  FROM obs WHERE event_type = 'error' AND k >= 10 AND qty <= 200
), rolled AS (
  SELECT *, quantile_cont(offset_ms, 0.5) OVER w AS clock_offset_ms, quantile_cont(rtt_ms, 0.5) OVER w AS clock_rtt_ms, min(rtt_ms) OVER w AS clock_min_rtt_ms,
         count(*) OVER w AS clock_samples, offset_ms - first(offset_ms) OVER w AS clock_drift_ms, list(offset_ms) OVER w AS offsets
  FROM clk WINDOW w AS (PARTITION BY symbol ORDER BY capture_seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
)"""
# an observation's label: the first one at or after the horizon (of one instant the first captured), with nothing bad or a boundary on the way;
# what is bad at an instant is so for all its rows
MARKED = """marked AS (
  SELECT *, sum(flag) OVER w AS bad FROM (
    SELECT *, CASE WHEN NOT feature_valid OR monotonic_ns - max(monotonic_ns) OVER (PARTITION BY symbol ORDER BY monotonic_ns RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 3000000000 THEN 1 ELSE 0 END AS flag FROM mids
  ) WINDOW w AS (PARTITION BY symbol ORDER BY monotonic_ns RANGE UNBOUNDED PRECEDING)
), placed AS (
  SELECT m.*, coalesce(b.n, 0) AS passed FROM marked m ASOF LEFT JOIN (
    SELECT symbol, monotonic_ns, row_number() OVER (PARTITION BY symbol ORDER BY monotonic_ns) AS n FROM (SELECT DISTINCT symbol, monotonic_ns FROM bnd)
  ) b ON m.symbol = b.symbol AND m.monotonic_ns >= b.monotonic_ns
)"""


def _label(h: str) -> str:
    ns = HORIZONS[h]
    return f"""l_{h} AS (
  SELECT m.symbol, m.capture_seq, m.p, m.monotonic_ns, t.monotonic_ns AS t_ns, t.p AS t_p,
         t.monotonic_ns - m.monotonic_ns - {ns} <= 3000000000 AND t.bad = m.bad - m.flag AND t.passed = m.passed AS ok
  FROM (SELECT *, monotonic_ns + {ns} AS due FROM placed) m ASOF LEFT JOIN (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY symbol, monotonic_ns ORDER BY capture_seq) = 1) t ON m.symbol = t.symbol AND m.due <= t.monotonic_ns
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


def r(expr: str, name: str, digits: int = 9) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {name}"


def _pairs(h: str = "1s") -> tuple[str, ...]:
    return (OBS, MIDS, BOUNDS, MARKED, _label(h), f"pairs AS (SELECT m.symbol, m.capture_seq, m.monotonic_ns, m.ts, m.x, CASE WHEN l.ok THEN ln(l.t_p / l.p) END AS y FROM mids m JOIN l_{h} l USING (capture_seq) WHERE m.feature_valid)")


def _corr(n: int = 2) -> str:
    return f"CASE WHEN count(*) >= {n} AND var_pop(x) > 0 AND var_pop(y) > 0 THEN corr(x, y) END"


LEVELS = """levels AS (
  SELECT l_orderkey AS book_id, CASE WHEN l_linenumber % 2 = 1 THEN 'bid' ELSE 'ask' END AS side, CAST(l_extendedprice / l_quantity AS DECIMAL(18,8)) AS price,
         CAST(l_quantity AS DECIMAL(18,8)) AS quantity, l_linenumber, l_partkey, l_suppkey FROM lineitem
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY book_id, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END, l_linenumber, l_partkey, l_suppkey, quantity) AS lvl FROM levels
)"""
BEST = """best AS (
  SELECT book_id, max(CASE WHEN side = 'bid' AND lvl = 1 THEN price END) AS b, max(CASE WHEN side = 'ask' AND lvl = 1 THEN price END) AS a,
         max(CASE WHEN side = 'bid' AND lvl = 1 THEN quantity END) AS bq, max(CASE WHEN side = 'ask' AND lvl = 1 THEN quantity END) AS aq FROM placed GROUP BY book_id
), tops AS (
  SELECT book_id, CAST(b AS DOUBLE) AS b, CAST(a AS DOUBLE) AS a, CAST(bq AS DOUBLE) AS bq, CAST(aq AS DOUBLE) AS aq, CAST(a + b AS DOUBLE) / 2 AS m, CAST(a - b AS DOUBLE) AS s FROM best
), micro AS (SELECT *, CASE WHEN bq + aq > 0 THEN (a * bq + b * aq) / (bq + aq) END AS mp FROM tops)"""

_depth = ", ".join(
    f"coalesce(sum(CASE WHEN side = '{s}' AND lvl <= {n} THEN quantity END), 0) AS {s}_volume_l{n}" for n in (1, 5, 10) for s in ("bid", "ask")
)
_flow = []
for _n, _w in WINDOWS.items():
    _in = f"e.monotonic_ns >= t.monotonic_ns - {_w}"
    _flow += [
        f"coalesce(sum(CASE WHEN {_in} AND e.side = 'BUY' THEN e.qty END), 0) AS buy_{_n}",
        f"coalesce(sum(CASE WHEN {_in} AND e.side = 'SELL' THEN e.qty END), 0) AS sell_{_n}",
        f"coalesce(sum(CASE WHEN {_in} THEN CAST(e.price AS DECIMAL(19,8)) * e.qty END), 0) AS notional_{_n}",
        f"count(CASE WHEN {_in} THEN 1 END) AS count_{_n}",
    ]
_flow_out = []
for _n in WINDOWS:
    _tot = f"(buy_{_n} + sell_{_n})"
    _flow_out += [r(f"buy_{_n}", f"buy_{_n}", 6), r(f"sell_{_n}", f"sell_{_n}", 6), r(f"notional_{_n}", f"notional_{_n}", 6), f"count_{_n}"]
    _flow_out += [r(f"buy_{_n} - sell_{_n}", f"signed_{_n}", 6), r(_tot, f"total_{_n}", 6)]
    _flow_out += [
        r(f"CASE WHEN {_tot} > 0 THEN CAST({v} AS DOUBLE) / CAST({_tot} AS DOUBLE) END", f"{name}_{_n}", 6)
        for v, name in ((f"buy_{_n} - sell_{_n}", "imbalance"), (f"buy_{_n}", "buy_ratio"), (f"notional_{_n}", "vwap"))
    ]


def _return(h: str, ns: int) -> str:
    return f"""r_{h} AS (
  SELECT m.capture_seq, CASE WHEN t.monotonic_ns >= m.monotonic_ns - 15000000000 THEN ln(m.p / t.p) END AS v
  FROM (SELECT *, monotonic_ns - {ns} AS due FROM mids) m ASOF LEFT JOIN (SELECT * FROM mids QUALIFY row_number() OVER (PARTITION BY symbol, monotonic_ns ORDER BY capture_seq DESC) = 1) t ON m.symbol = t.symbol AND m.due >= t.monotonic_ns
)"""


def _vol(w: str, ns: int) -> str:
    # squares are summed as exact decimals, as the query does: a sum of doubles depends on the order of its rows
    return f"""v_{w} AS (
  SELECT m.capture_seq, sqrt(CAST(sum(CAST(power(ln(e.p / e.prev_p), 2) AS DECIMAL(38,28))) AS DOUBLE)) AS v
  FROM mids m LEFT JOIN steps e ON m.symbol = e.symbol AND e.monotonic_ns <= m.monotonic_ns AND e.prev_ns >= m.monotonic_ns - {ns} GROUP BY m.capture_seq
)"""


STEPS = "steps AS (SELECT *, lag(p) OVER w AS prev_p, lag(monotonic_ns) OVER w AS prev_ns FROM mids WINDOW w AS (PARTITION BY symbol ORDER BY monotonic_ns))"
_flow_1s = """f_1s AS (
  SELECT t.capture_seq, coalesce(sum(CASE WHEN e.side = 'BUY' THEN e.qty END), 0) AS buy, coalesce(sum(CASE WHEN e.side = 'SELL' THEN e.qty END), 0) AS sell, count(e.capture_seq) AS n
  FROM mids t LEFT JOIN trades e ON t.symbol = e.symbol AND e.monotonic_ns BETWEEN t.monotonic_ns - 1000000000 AND t.monotonic_ns AND e.capture_seq <= t.capture_seq GROUP BY t.capture_seq
), i_1s AS (SELECT capture_seq, n, CASE WHEN buy + sell > 0 THEN CAST(buy - sell AS DOUBLE) / CAST(buy + sell AS DOUBLE) END AS imb FROM f_1s)"""
_EPOCHS = """c AS (SELECT m.capture_session_id, m.symbol, m.capture_seq, m.monotonic_ns // 500000000 * 500000000 AS ns, m.p, coalesce(b.n, 0) AS epoch
  FROM mids m ASOF LEFT JOIN (SELECT symbol, capture_seq, row_number() OVER (PARTITION BY symbol ORDER BY capture_seq) AS n FROM obs WHERE event_type = 'error' AND k < 10) b ON m.symbol = b.symbol AND m.capture_seq >= b.capture_seq),
ret AS (SELECT m.capture_seq, h.h, ln(m.p / arg_max(e.p, e.capture_seq)) AS v FROM (VALUES (1000000000), (5000000000)) h(h), c m JOIN c e ON m.symbol = e.symbol AND m.epoch = e.epoch AND e.ns <= m.ns - h.h AND e.ns >= m.ns - 15000000000 GROUP BY m.capture_seq, m.p, h.h),
seen AS (SELECT m.capture_seq, e.ns, arg_max(e.p, e.capture_seq) AS p FROM c m JOIN c e ON m.symbol = e.symbol AND m.epoch = e.epoch AND e.capture_seq <= m.capture_seq AND e.ns >= m.ns - 5000000000 GROUP BY m.capture_seq, e.ns),
vol AS (SELECT capture_seq, CASE WHEN count(*) >= 2 THEN sqrt(sum(q)) END AS v FROM (SELECT capture_seq, power(ln(p / lag(p) OVER (PARTITION BY capture_seq ORDER BY ns)), 2) AS q FROM seen) GROUP BY capture_seq)"""
_CIVIL = "bnd AS (SELECT symbol, monotonic_ns FROM obs WHERE event_type = 'error' AND k < 10 UNION ALL SELECT symbol, monotonic_ns FROM mids WHERE hour(ts) NOT BETWEEN 6 AND 17)"
_SEGMENTS = """v AS (SELECT m.*, strftime(ts, '%Y-%m-%d') AS segment FROM mids m WHERE feature_valid),
labs AS (SELECT capture_seq, '500ms' AS horizon, ln(t_p / p) AS y FROM l_500ms WHERE ok UNION ALL SELECT capture_seq, '1s', ln(t_p / p) FROM l_1s WHERE ok),
pairs AS (SELECT v.capture_session_id, v.symbol, v.segment, v.capture_seq, f.feature, l.horizon, f.x, l.y FROM v JOIN r_1s a USING (capture_seq) JOIN labs l USING (capture_seq), LATERAL (SELECT 'x' AS feature, v.x AS x UNION ALL SELECT 'return_1s', a.v) f WHERE f.x IS NOT NULL),
hop AS MATERIALIZED (SELECT h.horizon, a.symbol, a.segment, a.capture_seq, a.monotonic_ns + h.ns AS due FROM v a, (VALUES ('500ms', 500000000), ('1s', 1000000000)) h(horizon, ns)),
next_ AS MATERIALIZED (SELECT a.horizon, a.symbol, a.segment, a.capture_seq, b.capture_seq AS next_seq FROM hop a ASOF LEFT JOIN v b ON a.symbol = b.symbol AND a.segment = b.segment AND a.due <= b.monotonic_ns),
chain AS (SELECT horizon, symbol, segment, min(capture_seq) AS capture_seq FROM hop GROUP BY ALL UNION ALL SELECT n.horizon, n.symbol, n.segment, n.next_seq FROM chain c JOIN next_ n ON n.horizon = c.horizon AND n.capture_seq = c.capture_seq WHERE n.next_seq IS NOT NULL),
apart AS (SELECT p.symbol, p.segment, p.feature, p.horizon, count(*) AS apart_n, CASE WHEN count(*) >= 2 AND var_pop(x) > 0 AND var_pop(y) > 0 THEN covar_pop(x, y) / (sqrt(var_pop(x)) * sqrt(var_pop(y))) END AS apart_pearson FROM pairs p JOIN chain c ON c.horizon = p.horizon AND c.capture_seq = p.capture_seq GROUP BY ALL),
placed_ AS (SELECT *, rank() OVER (PARTITION BY symbol, segment, feature, horizon ORDER BY x) + (count(*) OVER (PARTITION BY symbol, segment, feature, horizon, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY symbol, segment, feature, horizon ORDER BY y) + (count(*) OVER (PARTITION BY symbol, segment, feature, horizon, y) - 1) / 2.0 AS ry FROM pairs),
whole AS (SELECT capture_session_id, symbol, segment, feature, horizon, count(*) AS n, CASE WHEN count(*) >= 2 AND var_pop(x) > 0 AND var_pop(y) > 0 THEN covar_pop(x, y) / (sqrt(var_pop(x)) * sqrt(var_pop(y))) END AS pearson,
  CASE WHEN count(*) >= 2 AND var_pop(rx) > 0 AND var_pop(ry) > 0 THEN covar_pop(rx, ry) / (sqrt(var_pop(rx)) * sqrt(var_pop(ry))) END AS spearman,
  CASE WHEN any_value(feature) = 'x' THEN count(CASE WHEN abs(x) >= 0.6 THEN 1 END) END AS signal_n, avg(CASE WHEN feature = 'x' AND x >= 0.6 THEN y WHEN feature = 'x' AND x <= -0.6 THEN -y END) * 10000 AS edge_bps FROM placed_ GROUP BY ALL)"""
SIGNALS = """fired AS (
  SELECT m.capture_session_id, m.symbol, m.capture_seq, m.monotonic_ns, s.strategy, CASE WHEN s.lo >= 0 THEN 'LONG' ELSE 'SHORT' END AS side, s.score FROM (
    SELECT m.*, i.imb FROM mids m JOIN i_1s i USING (capture_seq) WHERE feature_valid
  ) m, LATERAL (
    SELECT 'microprice_momentum' AS strategy, x AS lo, abs(x / 10.0) AS score WHERE (x / CAST(10 AS DOUBLE) >= 0.05 AND x >= 0.2) OR (x / CAST(10 AS DOUBLE) <= -0.05 AND x <= -0.2)
    UNION ALL SELECT 'book_imbalance', x, abs(x) WHERE abs(x) >= 0.6
    UNION ALL SELECT 'trade_flow', imb, abs(imb) WHERE abs(imb) >= 0.6
    UNION ALL SELECT 'combined_baseline', x, least(abs(x / 10.0) / 0.03, abs(x) / 0.4, abs(imb) / 0.4)
      WHERE (x / CAST(10 AS DOUBLE) >= 0.03 AND x >= 0.4 AND imb >= 0.4) OR (x / CAST(10 AS DOUBLE) <= -0.03 AND x <= -0.4 AND imb <= -0.4)
  ) s
)"""
# the positions: from a signal to the first row a second later, and on from there
SHADOW = """rows_ AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY capture_seq) AS i, CASE WHEN feature_valid AND x >= 0.6 THEN 'LONG' WHEN feature_valid AND x <= -0.6 THEN 'SHORT' END AS side, 1.0 + k / CAST(100 AS DOUBLE) AS spr FROM mids
), hop AS (
  SELECT a.*, b.i AS exit_i, b.monotonic_ns AS exit_ns, b.p AS exit_p, b.spr AS exit_spr
  FROM (SELECT *, monotonic_ns + 1000000000 AS due FROM rows_ WHERE side IS NOT NULL) a ASOF JOIN rows_ b ON a.symbol = b.symbol AND a.due <= b.monotonic_ns
), after_ AS (
  SELECT h.*, n.i AS next_i FROM hop h ASOF LEFT JOIN (SELECT symbol, i FROM hop) n ON h.symbol = n.symbol AND h.exit_i <= n.i
), chain AS (
  SELECT symbol, min(i) AS i FROM hop GROUP BY symbol
  UNION ALL SELECT c.symbol, a.next_i FROM chain c JOIN after_ a ON a.symbol = c.symbol AND a.i = c.i WHERE a.next_i IS NOT NULL
), taken AS (
  SELECT a.symbol, a.side, a.i, a.exit_i, a.monotonic_ns AS entry_ns, a.exit_ns, a.p AS entry_mid, a.exit_p AS exit_mid, a.spr AS es, a.exit_spr AS xs,
         (SELECT max(p) FROM rows_ r WHERE r.symbol = a.symbol AND r.i BETWEEN a.i AND a.exit_i) AS hi, (SELECT min(p) FROM rows_ r WHERE r.symbol = a.symbol AND r.i BETWEEN a.i AND a.exit_i) AS lo
  FROM chain c JOIN after_ a ON a.symbol = c.symbol AND a.i = c.i
), costed AS (
  SELECT *, CASE WHEN side = 'LONG' THEN 1.0 ELSE -1.0 END AS sgn, 1000.0 / entry_mid AS q FROM taken
), filled AS (
  SELECT *, entry_mid * (1 + sgn * (0.5 + es / 2) / 10000) AS ep, exit_mid * (1 - sgn * (0.5 + xs / 2) / 10000) AS xp FROM costed
), pnl AS (
  SELECT *, sgn * q * (exit_mid - entry_mid) AS gross_pnl, sgn * q * (xp - ep) AS before_fees, q * (ep * 2.0 + xp * 2.0) / 10000 AS fees, (exit_ns - entry_ns) / 1e6 AS holding_time_ms,
         CASE WHEN side = 'LONG' THEN ln(hi / entry_mid) ELSE -ln(lo / entry_mid) END * 10000 AS mfe_bps, CASE WHEN side = 'LONG' THEN ln(lo / entry_mid) ELSE -ln(hi / entry_mid) END * 10000 AS mae_bps FROM filled
), trades_ AS (SELECT *, 'book_imbalance' AS strategy, gross_pnl - before_fees AS slippage_cost, before_fees - fees AS net_pnl FROM pnl)"""

_lagged = """lagged AS (
  SELECT t.capture_session_id, t.symbol, t.capture_seq, t.monotonic_ns, CAST(t.qty AS DOUBLE) AS raw_lag_ms, c.clock_offset_ms, CAST(t.qty AS DOUBLE) + c.clock_offset_ms AS corrected_lag_ms
  FROM trades t ASOF LEFT JOIN rolled c ON t.symbol = c.symbol AND t.capture_seq >= c.capture_seq
)"""
_rolled_ts = "rolled_ts AS (SELECT * REPLACE (CASE WHEN k = 7 THEN ts - INTERVAL 2 HOUR ELSE ts END AS ts) FROM obs)"
_summary = "summary AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS name, CAST({e} AS DOUBLE) AS v FROM mids m JOIN r_1s a USING (capture_seq) JOIN r_10s b USING (capture_seq)" for n, e in (("price", "price"), ("qty", "qty"), ("x", "x"), ("return_1s", "a.v"), ("return_10s", "b.v"))
) + ")"
_lags = (250, 500, 1000, 2000, 5000)

SQL: dict[str, str] = {
    "mid_spread_microprice": f"{with_(LEVELS, BEST)} SELECT book_id, b AS best_bid, a AS best_ask, m AS mid_price, s AS spread, {r('CASE WHEN m <> 0 THEN s / m * 10000 END', 'spread_bps', 6)}, {r('mp', 'microprice', 6)}, {r('(mp - m) / m * 10000', 'microprice_offset_bps', 6)} FROM micro",
    "depth_imbalance": f"{with_(LEVELS)}, v AS (SELECT book_id, {_depth} FROM placed GROUP BY book_id) SELECT book_id, "
    + ", ".join(r(f"{s}_volume_l{n}", f"{s}_volume_l{n}") for n in (1, 5, 10) for s in ("bid", "ask"))
    + ", "
    + ", ".join(r(f"CASE WHEN bid_volume_l{n} + ask_volume_l{n} <> 0 THEN CAST(bid_volume_l{n} - ask_volume_l{n} AS DOUBLE) / CAST(bid_volume_l{n} + ask_volume_l{n} AS DOUBLE) END", f"imbalance_l{n}") for n in (1, 5, 10))
    + " FROM v",
    "book_violations": f"""{with_(LEVELS)}, found AS (
        SELECT book_id, CASE WHEN price <= 0 THEN 'PRICE' ELSE 'QUANTITY' END AS error FROM levels WHERE price <= 0 OR quantity < 0
        UNION ALL SELECT book_id, 'DUPLICATE_PRICE' FROM levels GROUP BY book_id, side, price HAVING count(*) > 1
        UNION ALL SELECT book_id, CASE WHEN b IS NULL OR a IS NULL THEN 'EMPTY_SIDE' ELSE 'CROSSED' END FROM (SELECT book_id, max(CASE WHEN side = 'bid' THEN price END) AS b, min(CASE WHEN side = 'ask' THEN price END) AS a FROM levels GROUP BY book_id) WHERE b IS NULL OR a IS NULL OR b >= a
        ) SELECT error, count(*) AS violations, count(DISTINCT book_id) AS books FROM found GROUP BY error""",
    "ordered_union_events": f"""{with_(OBS)}, u AS (SELECT capture_session_id, symbol, capture_seq, monotonic_ns, CASE WHEN event_type IN ('click', 'view') THEN 'trade' WHEN event_type = 'purchase' THEN 'book' WHEN event_type = 'signup' THEN 'tick' WHEN k < 10 THEN 'boundary' END AS kind, CAST(price AS DOUBLE) AS price FROM obs)
        SELECT *, lag(kind) OVER (PARTITION BY symbol ORDER BY capture_seq) AS prev_kind FROM u WHERE kind IS NOT NULL""",
    "sequence_violations": f"""{with_(OBS)}, c AS (SELECT capture_session_id, capture_seq, CASE WHEN capture_seq = 200 THEN monotonic_ns - 1000000000000 ELSE monotonic_ns END AS ns FROM obs WHERE capture_seq <> 300 UNION ALL SELECT capture_session_id, capture_seq, monotonic_ns FROM obs WHERE capture_seq = 100),
        p AS (SELECT *, lag(ns) OVER w AS prev_ns, lag(capture_seq) OVER w AS prev_seq FROM c WINDOW w AS (PARTITION BY capture_session_id ORDER BY capture_seq))
        SELECT capture_session_id, capture_seq, 'DUPLICATE' AS error FROM c GROUP BY ALL HAVING count(*) > 1
        UNION ALL SELECT capture_session_id, capture_seq, 'CLOCK_BACK' FROM p WHERE ns < prev_ns
        UNION ALL SELECT capture_session_id, capture_seq, 'GAP' FROM p WHERE capture_seq > prev_seq + 1""",
    "trade_flow": f"""{with_(OBS, TRADES)}, s AS (SELECT t.capture_session_id, t.symbol, t.capture_seq, t.monotonic_ns, {', '.join(_flow)} FROM (SELECT * FROM obs WHERE event_type = 'signup') t
        LEFT JOIN trades e ON t.symbol = e.symbol AND e.monotonic_ns BETWEEN t.monotonic_ns - 10000000000 AND t.monotonic_ns AND e.capture_seq <= t.capture_seq GROUP BY ALL)
        SELECT capture_session_id, symbol, capture_seq, monotonic_ns, {', '.join(_flow_out)} FROM s""",
    "returns_backward": f"{with_(OBS, MIDS, *[_return(h, n) for h, n in (('250ms', SECOND // 4), *WINDOWS.items())])} SELECT m.capture_session_id, m.symbol, m.capture_seq, m.monotonic_ns, "
    + ", ".join(r(f"r_{h}.v", f"return_{h}") for h in ("250ms", *WINDOWS))
    + " FROM mids m "
    + " ".join(f"JOIN r_{h} USING (capture_seq)" for h in ("250ms", *WINDOWS)),
    "realized_volatility": f"{with_(OBS, MIDS, STEPS, *[_vol(w, n) for w, n in WINDOWS.items()])} SELECT m.capture_session_id, m.symbol, m.capture_seq, m.monotonic_ns, "
    + ", ".join(r(f"v_{w}.v", f"realized_volatility_{w}") for w in WINDOWS)
    + " FROM mids m "
    + " ".join(f"JOIN v_{w} USING (capture_seq)" for w in WINDOWS),
    "feature_table": f"""{with_(OBS, MIDS, TRADES, STEPS, CLOCK, _return('1s', SECOND), _vol('5s', 5 * SECOND), _flow_1s)}
        SELECT m.capture_session_id, m.symbol, m.capture_seq, m.monotonic_ns, {r('a.v', 'return_1s')}, {r('b.v', 'realized_volatility_5s')}, {r('i.imb', 'imbalance_1s')}, i.n AS count_1s, {r('c.clock_offset_ms', 'clock_offset_ms')},
        array_to_string(list_filter([CASE WHEN NOT feature_valid THEN 'invalid_tick' END, CASE WHEN a.v IS NULL THEN 'no_return' END, CASE WHEN b.v IS NULL THEN 'no_volatility' END, CASE WHEN i.n = 0 THEN 'no_trades' END, CASE WHEN c.clock_offset_ms IS NULL THEN 'no_clock' END], lambda z: z IS NOT NULL), ',') AS invalid_reasons
        FROM (SELECT * FROM mids) m ASOF LEFT JOIN rolled c ON m.symbol = c.symbol AND m.capture_seq >= c.capture_seq JOIN r_1s a ON a.capture_seq = m.capture_seq JOIN v_5s b ON b.capture_seq = m.capture_seq JOIN i_1s i ON i.capture_seq = m.capture_seq""",
    "forward_labels": f"{with_(OBS, MIDS, BOUNDS, MARKED, *map(_label, HORIZONS))} SELECT m.capture_session_id, m.symbol, m.capture_seq, m.monotonic_ns, "
    + ", ".join(r(f"CASE WHEN l_{h}.ok THEN ln(l_{h}.t_p / l_{h}.p) END", f"future_return_{h}") for h in HORIZONS)
    + " FROM mids m "
    + " ".join(f"JOIN l_{h} ON l_{h}.capture_seq = m.capture_seq" for h in HORIZONS),
    "label_excursions": f"{with_(OBS, MIDS, BOUNDS, MARKED, *map(_label, ('1s', '2s', '5s')))}, "
    + ", ".join(
        f"e_{h} AS (SELECT l.capture_seq, ln(max(e.p) / l.p) * 10000 AS up, ln(min(e.p) / l.p) * 10000 AS down FROM l_{h} l JOIN mids e ON e.symbol = l.symbol AND e.monotonic_ns > l.monotonic_ns AND e.monotonic_ns <= l.t_ns WHERE l.ok GROUP BY l.capture_seq, l.p)"
        for h in ("1s", "2s", "5s")
    )
    + " SELECT m.capture_session_id, m.symbol, m.capture_seq, "
    + ", ".join(r(f"e_{h}.{s}", f"future_max_{s}_bps_{h}", 6) for h in ("1s", "2s", "5s") for s in ("up", "down"))
    + " FROM mids m "
    + " ".join(f"LEFT JOIN e_{h} ON e_{h}.capture_seq = m.capture_seq" for h in ("1s", "2s", "5s")),
    "feature_label_join": f"{with_(OBS, MIDS, BOUNDS, MARKED, _label('1s'), _return('1s', SECOND))} SELECT m.capture_session_id, m.symbol, m.monotonic_ns, {r('m.x', 'x')}, {r('a.v', 'return_1s')}, {r('CASE WHEN l.ok THEN ln(l.t_p / l.p) END', 'future_return_1s')} FROM mids m JOIN r_1s a USING (capture_seq) JOIN l_1s l USING (capture_seq)",
    "feature_history_epochs": f"{with_(OBS, MIDS, _EPOCHS)} SELECT c.capture_session_id, c.symbol, c.capture_seq, c.ns AS monotonic_ns, c.epoch, {r('a.v', 'return_1s')}, {r('b.v', 'return_5s')}, {r('v.v', 'realized_volatility_5s')} FROM c LEFT JOIN ret a ON a.capture_seq = c.capture_seq AND a.h = 1000000000 LEFT JOIN ret b ON b.capture_seq = c.capture_seq AND b.h = 5000000000 LEFT JOIN vol v ON v.capture_seq = c.capture_seq",
    "civil_range_labels": f"{with_(OBS, MIDS, _CIVIL, MARKED, _label('500ms'), _label('1s'))} SELECT m.capture_session_id, m.symbol, m.capture_seq, {r('CASE WHEN a.ok THEN ln(a.t_p / a.p) END', 'future_return_500ms')}, {r('CASE WHEN b.ok THEN ln(b.t_p / b.p) END', 'future_return_1s')} FROM mids m JOIN l_500ms a USING (capture_seq) JOIN l_1s b USING (capture_seq) WHERE hour(m.ts) BETWEEN 6 AND 17",
    "segment_report": "WITH RECURSIVE " + with_(OBS, MIDS, BOUNDS, MARKED, _label("500ms"), _label("1s"), _return("1s", SECOND), _SEGMENTS)[5:] + f" SELECT w.capture_session_id, w.symbol, w.segment, w.feature, w.horizon, n, {r('pearson', 'pearson', 6)}, {r('spearman', 'spearman', 6)}, coalesce(apart_n, 0) AS apart_n, {r('apart_pearson', 'apart_pearson', 6)}, signal_n, {r('edge_bps', 'edge_bps', 6)} FROM whole w LEFT JOIN apart a ON w.symbol = a.symbol AND w.segment = a.segment AND w.feature = a.feature AND w.horizon = a.horizon",
    "feature_label_correlation": f"""{with_(OBS, MIDS, BOUNDS, MARKED, STEPS, *map(_label, ('500ms', '1s', '5s')), _return('250ms', SECOND // 4), _return('1s', SECOND), _vol('5s', 5 * SECOND))},
        feats AS (SELECT m.symbol, m.capture_seq, f.feature, f.x FROM mids m JOIN r_250ms a USING (capture_seq) JOIN r_1s b USING (capture_seq) JOIN v_5s v USING (capture_seq), LATERAL (SELECT 'x' AS feature, m.x AS x UNION ALL SELECT 'return_250ms', a.v UNION ALL SELECT 'return_1s', b.v UNION ALL SELECT 'realized_volatility_5s', v.v) f WHERE m.feature_valid),
        labs AS ({' UNION ALL '.join(f"SELECT capture_seq, '{h}' AS horizon, ln(t_p / p) AS y FROM l_{h} WHERE ok" for h in ('500ms', '1s', '5s'))}),
        both_ AS (SELECT symbol, feature, horizon, x, y FROM feats JOIN labs USING (capture_seq) WHERE x IS NOT NULL AND y IS NOT NULL),
        ranks AS (SELECT *, rank() OVER (PARTITION BY symbol, feature, horizon ORDER BY x) + (count(*) OVER (PARTITION BY symbol, feature, horizon, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY symbol, feature, horizon ORDER BY y) + (count(*) OVER (PARTITION BY symbol, feature, horizon, y) - 1) / 2.0 AS ry FROM both_)
        SELECT symbol, feature, horizon, count(*) AS n, {r(_corr(), 'pearson', 8)}, {r('corr(rx, ry)', 'spearman', 8)} FROM ranks GROUP BY ALL""",
    "chronological_split": f"""{with_(OBS, MIDS)}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY monotonic_ns, capture_seq) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM mids),
        c AS (SELECT *, greatest(1, CAST(floor(n * CAST(0.6 AS DOUBLE)) AS BIGINT)) AS c1 FROM n), c2 AS (SELECT *, greatest(c1 + 1, CAST(floor(n * (CAST(0.6 AS DOUBLE) + CAST(0.2 AS DOUBLE))) AS BIGINT)) AS c2 FROM c),
        e AS (SELECT *, max(CASE WHEN i = c1 - 1 THEN monotonic_ns END) OVER (PARTITION BY symbol) AS e1, max(CASE WHEN i = c2 - 1 THEN monotonic_ns END) OVER (PARTITION BY symbol) AS e2, CASE WHEN i < c1 THEN 'train' WHEN i < c2 THEN 'validation' ELSE 'test' END AS part FROM c2)
        SELECT capture_session_id, symbol, part, count(*) AS rows, min(monotonic_ns) AS first_ns, max(monotonic_ns) AS last_ns FROM e WHERE part = 'test' OR monotonic_ns + 10000000000 <= CASE part WHEN 'train' THEN e1 ELSE e2 END GROUP BY ALL""",
    "corr_pearson_spearman": f"""{with_(*_pairs())}, g AS (SELECT * FROM pairs WHERE y IS NOT NULL), k AS (SELECT symbol, x, y, rank() OVER (PARTITION BY symbol ORDER BY x) + (count(*) OVER (PARTITION BY symbol, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY symbol ORDER BY y) + (count(*) OVER (PARTITION BY symbol, y) - 1) / 2.0 AS ry FROM g)
        SELECT symbol, count(*) AS n, {r(_corr(), 'pearson')}, {r('corr(rx, ry)', 'spearman')} FROM k GROUP BY symbol""",
    "quantile_bins": f"""{with_(*_pairs())}, k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY x, capture_seq) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM pairs WHERE y IS NOT NULL), b AS (SELECT *, (rn * 10 - 1) // n AS bin FROM k)
        SELECT symbol, bin, count(*) AS count, {r('min(x)', 'min_x')}, {r('max(x)', 'max_x')}, {r('avg(y)', 'mean_y')}, {r('stddev_samp(y)', 'std_y')}, {r('stddev_samp(y) / sqrt(count(*))', 'std_error')} FROM b GROUP BY symbol, bin""",
    "hit_rates": f"""{with_(*_pairs())}, g AS (SELECT CAST(t AS DOUBLE) AS threshold, dir AS direction FROM (VALUES (0.2), (0.4), (0.6)) a(t), (VALUES ('LONG'), ('SHORT')) b(dir)),
        h AS (SELECT p.symbol, g.threshold, g.direction, CASE WHEN (direction = 'LONG' AND x >= threshold) OR (direction = 'SHORT' AND x <= -threshold) THEN 1 ELSE 0 END AS hit, CASE WHEN (direction = 'LONG' AND y > 0) OR (direction = 'SHORT' AND y < 0) THEN 1 ELSE 0 END AS good FROM pairs p, g WHERE y IS NOT NULL)
        SELECT symbol, {r('threshold', 'threshold')}, direction, CAST(sum(hit) AS BIGINT) AS count, CAST(sum(hit * good) AS BIGINT) AS hits, {r('CASE WHEN sum(hit) > 0 THEN sum(hit * good) / sum(hit) END', 'hit_rate')} FROM h GROUP BY symbol, h.threshold, direction""",
    "data_quality_summary": f"""{with_(OBS, MIDS, _return('1s', SECOND), _return('10s', 10 * SECOND), _summary)}, k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY v) AS rn, count(*) OVER (PARTITION BY name) AS n FROM summary WHERE v IS NOT NULL),
        q AS (SELECT name, min(v) AS lo, quantile_cont(v, 0.5) AS med, max(CASE WHEN rn = CAST(floor((n - 1) * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1 THEN v END) AS p95, max(CASE WHEN rn = CAST(floor((n - 1) * CAST(0.99 AS DOUBLE)) AS BIGINT) + 1 THEN v END) AS p99, max(v) AS hi FROM k GROUP BY name)
        SELECT name, count(*) AS rows, count(*) FILTER (v IS NULL) AS missing, CAST(0 AS BIGINT) AS nan, CAST(0 AS BIGINT) AS inf, {r('any_value(lo)', 'min')}, {r('any_value(med)', 'median')}, {r('any_value(p95)', 'p95')}, {r('any_value(p99)', 'p99')}, {r('any_value(hi)', 'max')} FROM summary LEFT JOIN q USING (name) GROUP BY name""",
    "invariant_errors": f"""{with_(OBS, MIDS)} SELECT capture_session_id, symbol, capture_seq, e.error FROM mids, LATERAL (SELECT 'qty_small' AS error WHERE qty < 1 UNION ALL SELECT 'signal_range' WHERE abs(x) > 0.99 UNION ALL SELECT 'price_high' WHERE price > 580 UNION ALL SELECT 'invalid' WHERE NOT feature_valid) e""",
    "autocorrelation_grid": f"{with_(OBS, MIDS)}, v AS (SELECT * FROM mids WHERE feature_valid), "
    + ", ".join(f"a_{m} AS (SELECT a.symbol, CAST({m} AS INT) AS lag_ms, a.x AS x, b.x AS y FROM (SELECT *, monotonic_ns - {m * 1_000_000} AS due FROM v) a ASOF JOIN v b ON a.symbol = b.symbol AND a.due >= b.monotonic_ns WHERE b.monotonic_ns >= a.monotonic_ns - {m * 1_000_000 + 150_000_000})" for m in _lags)
    + ", u AS ("
    + " UNION ALL ".join(f"SELECT * FROM a_{m}" for m in _lags)
    + f") SELECT symbol, lag_ms, count(*) AS n, {r(_corr(), 'acf')} FROM u GROUP BY symbol, lag_ms",
    "moments_partial_final": f"{with_(*_pairs())} SELECT symbol, count(*) AS n, {r(_corr(3), 'correlation')} FROM pairs WHERE y IS NOT NULL GROUP BY symbol",
    "session_stability": f"""{with_(*_pairs())}, d AS (SELECT symbol, CAST(ts AS DATE) AS day, round({_corr()}, 9) AS c FROM pairs WHERE y IS NOT NULL GROUP BY ALL), m AS (SELECT symbol, quantile_cont(c, 0.5) AS med FROM d GROUP BY symbol)
        SELECT d.symbol, count(*) AS count, count(c) AS usable, {r('any_value(med)', 'median')}, {r('min(c)', 'min')}, {r('max(c)', 'max')}, {r('avg(CASE WHEN c IS NOT NULL THEN CASE WHEN sign(c) = sign(med) THEN 1.0 ELSE 0.0 END END)', 'same_sign')} FROM d JOIN m USING (symbol) GROUP BY d.symbol""",
    "vol_regime_corr": f"""{with_(*_pairs(), STEPS, _vol('5s', 5 * SECOND))}, g AS (SELECT p.*, round(v.v, 9) AS v FROM pairs p JOIN v_5s v USING (capture_seq)), k AS (SELECT symbol, v, row_number() OVER (PARTITION BY symbol ORDER BY v) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM g WHERE v IS NOT NULL),
        c AS (SELECT symbol, max(CASE WHEN rn = (n - 1) // 3 + 1 THEN v END) AS c0, max(CASE WHEN rn = (2 * (n - 1)) // 3 + 1 THEN v END) AS c1 FROM k GROUP BY symbol)
        SELECT g.symbol, CASE WHEN v IS NULL THEN 'UNAVAILABLE' WHEN v <= c0 THEN 'LOW' WHEN v <= c1 THEN 'MEDIUM' ELSE 'HIGH' END AS regime, count(*) AS n, {r(_corr(), 'pearson')} FROM g LEFT JOIN c USING (symbol) WHERE y IS NOT NULL GROUP BY ALL""",
    "cost_sensitivity": f"""{with_(*_pairs())}, e AS (SELECT symbol, round(avg(s), 9) AS edge, count(s) AS n FROM (SELECT symbol, CASE WHEN x >= 0.6 THEN y WHEN x <= -0.6 THEN -y END * 10000 AS s FROM pairs) GROUP BY symbol)
        SELECT symbol, {r('edge', 'edge_bps', 6)}, n, {r('c', 'cost_bps', 6)}, {r('edge - c', 'net_bps', 6)}, {r('CASE WHEN c <> 0 THEN edge / c END', 'edge_to_cost', 6)}, {r('edge', 'break_even_bps', 6)} FROM e, (SELECT CAST(unnest([0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0, 7.5, 10.0]) AS DOUBLE) AS c)""",
    "signals_all": f"{with_(OBS, MIDS, TRADES, _flow_1s, SIGNALS)} SELECT capture_session_id, symbol, capture_seq, monotonic_ns, strategy, side, {r('score', 'score')} FROM fired",
    "strategy_edges": f"""{with_(OBS, MIDS, TRADES, BOUNDS, MARKED, _label('1s'), _label('5s'), _flow_1s, SIGNALS)}, labs AS (SELECT capture_seq, '1s' AS horizon, ln(t_p / p) AS y FROM l_1s WHERE ok UNION ALL SELECT capture_seq, '5s', ln(t_p / p) FROM l_5s WHERE ok)
        SELECT strategy, horizon, count(*) AS n, {r("avg(CASE WHEN side = 'LONG' THEN y ELSE -y END * 10000)", 'edge_bps', 6)} FROM fired JOIN labs USING (capture_seq) GROUP BY strategy, horizon""",
    "nonoverlap_samples": """WITH RECURSIVE """
    + with_(OBS, MIDS)[5:]
    + """, hop AS MATERIALIZED (SELECT a.symbol, a.capture_seq, b.capture_seq AS next_seq FROM (SELECT *, monotonic_ns + 5000000000 AS due FROM mids) a ASOF LEFT JOIN mids b ON a.symbol = b.symbol AND a.due <= b.monotonic_ns),
        chain AS (SELECT symbol, min(capture_seq) AS capture_seq FROM mids GROUP BY symbol UNION ALL SELECT h.symbol, h.next_seq FROM chain c JOIN hop h ON h.symbol = c.symbol AND h.capture_seq = c.capture_seq WHERE h.next_seq IS NOT NULL)
        SELECT m.capture_session_id, m.symbol, m.capture_seq, m.monotonic_ns FROM chain JOIN mids m USING (capture_seq)""",
    "shadow_trades": "WITH RECURSIVE " + with_(OBS, MIDS, SHADOW)[5:] + " SELECT symbol, strategy, side, entry_ns, exit_ns, " + ", ".join(r(c, c, 6) for c in ("entry_mid", "exit_mid", "gross_pnl", "fees", "slippage_cost", "net_pnl", "mfe_bps", "mae_bps", "holding_time_ms")) + " FROM trades_",
    "strategy_metrics": "WITH RECURSIVE "
    + with_(OBS, MIDS, SHADOW)[5:]
    + """, run AS (SELECT *, sum(net_pnl) OVER w AS cum, sum(CASE WHEN net_pnl >= 0 THEN 1 ELSE 0 END) OVER w AS isl FROM trades_ WINDOW w AS (PARTITION BY symbol ORDER BY entry_ns ROWS UNBOUNDED PRECEDING)),
        peak AS (SELECT *, greatest(0, max(cum) OVER (PARTITION BY symbol ORDER BY entry_ns ROWS UNBOUNDED PRECEDING)) AS pk FROM run), streak AS (SELECT symbol, max(n) AS n FROM (SELECT symbol, isl, count(CASE WHEN net_pnl < 0 THEN 1 END) AS n FROM run GROUP BY symbol, isl) GROUP BY symbol)
        SELECT p.symbol, strategy, count(*) AS trade_count, count(CASE WHEN side = 'LONG' THEN 1 END) AS long_count, count(CASE WHEN side = 'SHORT' THEN 1 END) AS short_count, any_value(s.n) AS maximum_consecutive_losses, """
    + ", ".join(
        r(e, n, 5)
        for n, e in {
            "gross_pnl": "sum(gross_pnl)",
            "fees": "sum(fees)",
            "slippage_cost": "sum(slippage_cost)",
            "net_pnl": "sum(net_pnl)",
            "average_net_pnl": "avg(net_pnl)",
            "median_net_pnl": "quantile_cont(net_pnl, 0.5)",
            "win_rate": "avg(CASE WHEN net_pnl > 0 THEN 1.0 ELSE 0.0 END)",
            "average_win": "avg(CASE WHEN net_pnl > 0 THEN net_pnl END)",
            "average_loss": "avg(CASE WHEN net_pnl < 0 THEN net_pnl END)",
            "profit_factor": "sum(CASE WHEN net_pnl > 0 THEN net_pnl ELSE 0 END) / abs(sum(CASE WHEN net_pnl < 0 THEN net_pnl END))",
            "maximum_drawdown": "max(pk - cum)",
            "average_holding_time_ms": "avg(holding_time_ms)",
            "average_mfe_bps": "avg(mfe_bps)",
            "average_mae_bps": "avg(mae_bps)",
            "turnover": "count(*) * 2000.0",
            "cost_percent_of_gross": "CASE WHEN sum(gross_pnl) > 0 THEN (sum(fees) + sum(slippage_cost)) / sum(gross_pnl) * 100 END",
            "break_even_round_trip_cost_bps": "avg(gross_pnl / 1000.0 * 10000)",
        }.items()
    )
    + " FROM peak p JOIN streak s ON s.symbol = p.symbol GROUP BY p.symbol, strategy",
    "block_preaggregate": f"""{with_(*_pairs())}, g AS (SELECT *, (monotonic_ns - min(monotonic_ns) OVER (PARTITION BY symbol)) // 10000000000 AS block FROM pairs WHERE y IS NOT NULL)
        SELECT symbol, block, count(*) AS rows, {r('coalesce(sum(CASE WHEN x >= 0.6 THEN y * 10000 END), 0)', 'high_sum', 6)}, count(CASE WHEN x >= 0.6 THEN 1 END) AS high_count, {r('coalesce(sum(CASE WHEN x <= -0.6 THEN y * 10000 END), 0)', 'low_sum', 6)}, count(CASE WHEN x <= -0.6 THEN 1 END) AS low_count FROM g GROUP BY symbol, block""",
    "effective_sample_size": f"""{with_(OBS, MIDS)}, v AS (SELECT symbol, x, row_number() OVER (PARTITION BY symbol ORDER BY capture_seq) AS i, count(*) OVER (PARTITION BY symbol) AS n FROM mids WHERE feature_valid),
        a AS (SELECT p.symbol, k.k, corr(p.x, q.x) AS rho FROM range(1, 51) k(k), v p JOIN v q ON p.symbol = q.symbol AND p.i = q.i + k.k WHERE k.k < p.n // 3 GROUP BY ALL), f AS (SELECT symbol, min(k) FILTER (rho <= 0) AS stop FROM a GROUP BY symbol),
        s AS (SELECT v.symbol, count(*) AS n, coalesce((SELECT sum(rho) FROM a JOIN f USING (symbol) WHERE a.symbol = v.symbol AND (stop IS NULL OR k < stop)), 0) AS total FROM v GROUP BY v.symbol) SELECT symbol, n, {r('greatest(1.0, least(CAST(n AS DOUBLE), n / (1 + 2 * total)))', 'ess', 6)} FROM s""",
    "rolling_clock_median": f"{with_(OBS, CLOCK)} SELECT capture_session_id, symbol, capture_seq, clock_samples, {r('clock_offset_ms', 'clock_offset_ms', 6)}, {r('clock_rtt_ms', 'clock_rtt_ms', 6)}, {r('clock_min_rtt_ms', 'clock_min_rtt_ms', 6)}, {r('clock_drift_ms', 'clock_drift_ms', 6)}, {r('list_median(list_transform(offsets, lambda z: abs(z - clock_offset_ms)))', 'clock_mad_ms', 6)} FROM rolled",
    "clock_asof_lag": f"{with_(OBS, TRADES, CLOCK, _lagged)} SELECT capture_session_id, symbol, capture_seq, monotonic_ns, {r('raw_lag_ms', 'raw_lag_ms', 6)}, {r('clock_offset_ms', 'clock_offset_ms', 6)}, {r('corrected_lag_ms', 'corrected_lag_ms', 6)} FROM lagged",
    "top50_latency": f"{with_(OBS, TRADES, CLOCK, _lagged)} SELECT capture_session_id, symbol, capture_seq, c + 0.0 AS corrected_lag_ms, CAST(place AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY c DESC, capture_seq) AS place FROM (SELECT *, round(corrected_lag_ms, 6) AS c FROM lagged) WHERE c IS NOT NULL) WHERE place <= 50",
    "latency_distribution": f"""{with_(OBS, TRADES)}, g AS (SELECT capture_session_id, symbol, capture_seq, (monotonic_ns - lag(monotonic_ns) OVER (PARTITION BY symbol ORDER BY monotonic_ns)) / 1e6 AS v FROM trades),
        k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY capture_seq DESC) AS back FROM g WHERE v IS NOT NULL), q AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY v) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM k WHERE back <= 6000)
        SELECT g.capture_session_id, g.symbol, count(v) AS count, {r('avg(v)', 'mean', 6)}, {r('max(v)', 'max', 6)}, """
    + ", ".join(r(f"(SELECT v FROM q WHERE q.symbol = g.symbol AND rn = CAST(floor((n - 1) * CAST({p} AS DOUBLE)) AS BIGINT) + 1)", n, 6) for n, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))
    + " FROM g GROUP BY g.capture_session_id, g.symbol",
    "heartbeat_interval_join": f"""{with_(OBS)}, a AS (SELECT capture_session_id, symbol, capture_seq, monotonic_ns FROM obs WHERE event_type = 'purchase' AND k >= 90), b AS (SELECT symbol, capture_seq AS s, monotonic_ns AS ns, CAST(k AS DOUBLE) AS lag_ms FROM obs WHERE event_type = 'signup')
        SELECT a.capture_session_id, a.symbol, a.capture_seq, any_value(a.monotonic_ns) AS monotonic_ns, arg_max(b.lag_ms, b.s) AS nearby_lag_ms FROM a LEFT JOIN b ON a.symbol = b.symbol AND b.ns >= a.monotonic_ns AND (b.ns - a.monotonic_ns) / 1e6 <= 1000 + b.lag_ms GROUP BY ALL""",
    "hour_fragments": f"""{with_(OBS, _rolled_ts)}, h AS (SELECT *, date_trunc('hour', ts) AS hour FROM rolled_ts), p AS (SELECT *, CASE WHEN hour IS DISTINCT FROM lag(hour) OVER (PARTITION BY symbol ORDER BY capture_seq) THEN 1 ELSE 0 END AS fresh FROM h), f AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY capture_seq ROWS UNBOUNDED PRECEDING) AS fragment FROM p)
        SELECT capture_session_id, symbol, CAST(fragment AS BIGINT) AS fragment, min(capture_seq) AS first_seq, max(capture_seq) AS last_seq, count(*) AS rows FROM f GROUP BY ALL""",
    "wallclock_backsteps": f"""{with_(OBS, _rolled_ts)}, p AS (SELECT *, (lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY capture_seq) - epoch_us(ts)) / 1000.0 AS step FROM rolled_ts)
        SELECT capture_session_id, symbol, count(CASE WHEN step > 0 THEN 1 END) AS backward_steps, {r('max(CASE WHEN step > 0 THEN step END)', 'largest_ms', 3)}, max(CASE WHEN step > 0 THEN capture_seq END) AS last_seq FROM p GROUP BY ALL""",
    "emission_grid": f"{with_(OBS, MIDS)} SELECT capture_session_id, symbol, monotonic_ns // 1000000000 AS slot, min(capture_seq) AS capture_seq, min(monotonic_ns) AS monotonic_ns FROM mids GROUP BY capture_session_id, symbol, slot",
    "emit_on_change": f"{with_(OBS)} SELECT capture_session_id, symbol, capture_seq, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY symbol ORDER BY capture_seq) AS prev FROM obs) WHERE event_type IS DISTINCT FROM prev",
    "book_fold_topn": f"""{with_(OBS)}, u AS (SELECT *, CASE WHEN k % 2 = 0 THEN 'bid' ELSE 'ask' END AS side, CAST(round(price, 0) AS BIGINT) AS lvl_price, CASE WHEN event_type = 'error' THEN 0 ELSE k + 1 END AS q FROM obs), l AS (SELECT capture_session_id, symbol, side, lvl_price, arg_max(q, capture_seq) AS q FROM u GROUP BY ALL),
        k AS (SELECT *, row_number() OVER (PARTITION BY symbol, side ORDER BY CASE WHEN side = 'bid' THEN -lvl_price ELSE lvl_price END) AS level FROM l WHERE q > 0) SELECT capture_session_id, symbol, side, CAST(level AS INT) AS level, lvl_price AS price, CAST(q AS INT) AS quantity FROM k WHERE level <= 5""",
    "catalog_overlap_selection": """WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS capture_session_id, concat('SYM', CAST(o_orderkey % 4 AS VARCHAR)) AS symbol, o_orderkey AS file_id, o_orderdate AS s, o_orderdate + INTERVAL 7 DAY AS e FROM orders), o AS (SELECT * FROM f WHERE symbol = 'SYM1')
        SELECT capture_session_id, symbol, file_id FROM o WHERE capture_session_id IN (SELECT capture_session_id FROM o WHERE e >= TIMESTAMP '1996-03-01 00:00:00' AND s < TIMESTAMP '1996-04-01 00:00:00')""",
    "dataset_rollup": f"{with_(OBS)} SELECT symbol, event_type, count(*) AS rows, min(capture_seq) AS first_seq, max(capture_seq) AS last_seq, {r('count(*) / ((max(monotonic_ns) - min(monotonic_ns)) / 1e9)', 'rate_per_s', 6)}, count(DISTINCT k) AS kinds FROM obs GROUP BY symbol, event_type",
    "replay_differences": f"""{with_(OBS, MIDS, _return('1s', SECOND))}, d AS (SELECT m.capture_session_id, m.symbol, m.capture_seq, array_to_string(list_filter([CASE WHEN m.capture_seq % 97 = 0 THEN 'price' END, CASE WHEN m.capture_seq % 89 = 0 AND a.v IS NOT NULL THEN 'return_1s' END], lambda z: z IS NOT NULL), ',') AS differs FROM mids m JOIN r_1s a USING (capture_seq)) SELECT * FROM d WHERE differs <> ''""",
    "tumbling_counts_stream": f"{with_(OBS)} SELECT symbol, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start_s, count(*) AS rows, round(CAST(sum(qty) AS DOUBLE), 6) AS volume FROM obs GROUP BY ALL",
    "segment_comparison": f"""{with_(OBS, MIDS)}, g AS (SELECT symbol, capture_seq, p, 1.0 + k / CAST(100 AS DOUBLE) AS s, CASE WHEN p = lag(p) OVER (PARTITION BY symbol ORDER BY capture_seq) THEN 1.0 WHEN lag(p) OVER (PARTITION BY symbol ORDER BY capture_seq) IS NULL THEN NULL ELSE 0.0 END AS same FROM mids),
        k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY s, capture_seq) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM g) SELECT symbol, {r('quantile_cont(s, 0.5)', 'median_spread_bps')}, {r('max(CASE WHEN rn = CAST(floor((n - 1) * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1 THEN s END)', 'p95_spread_bps')}, {r('avg(same)', 'unchanged_fraction')} FROM k GROUP BY symbol""",
    "resource_slope": f"{with_(OBS)} SELECT symbol, {r('regr_slope(CAST(qty AS DOUBLE), monotonic_ns / 1e9)', 'slope', 7)} FROM obs GROUP BY symbol",
}
