"""Named queries over the driver tables, each built from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import prices
from tidemark.operators import book, checks, clock, history, labels, series, signals, stats
from tidemark.sources import catalog, projections
from tidemark.sources.projections import KEYS
from tidemark.streaming import counts

SECOND = series.SECOND
H = labels.HORIZONS


def _round(df: DataFrame, columns: list[str], digits: int = 9) -> DataFrame:
    """Doubles are compared across engines, so they are published rounded."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in columns})


def _obs(spark: SparkSession, d: str) -> DataFrame:
    return projections.observations(spark, d)


def _labelled(spark: SparkSession, d: str, horizons: list[str], excursions: tuple[str, ...] = ()) -> DataFrame:
    obs = _obs(spark, d)
    return labels.forward_labels(projections.mids(obs), projections.boundaries(obs), {h: H[h] for h in horizons}, excursions)


def mid_spread_microprice(spark: SparkSession, d: str) -> DataFrame:
    out = book.book_features(book.ladders(projections.book_levels(spark, d), depth=1), (1,))
    out = out.select("book_id", "best_bid", "best_ask", "mid_price", "spread", "spread_bps", "microprice", "microprice_offset_bps")
    out = out.withColumns({c: F.col(c).cast("double") for c in ("best_bid", "best_ask", "mid_price", "spread")})
    return _round(out, ["spread_bps", "microprice", "microprice_offset_bps"], 6)


def depth_imbalance(spark: SparkSession, d: str) -> DataFrame:
    out = book.book_features(book.ladders(projections.book_levels(spark, d), depth=10))
    names = [f"{s}_volume_l{n}" for n in (1, 5, 10) for s in ("bid", "ask")]
    out = out.select("book_id", *[F.col(n).cast("double").alias(n) for n in names], *[f"imbalance_l{n}" for n in (1, 5, 10)])
    return _round(out, out.columns[1:])


def book_violations(spark: SparkSession, d: str) -> DataFrame:
    found = book.level_violations(projections.book_levels(spark, d))
    return found.groupBy("error").agg(F.count(F.lit(1)).alias("violations"), F.countDistinct("book_id").alias("books"))


def ordered_union_events(spark: SparkSession, d: str) -> DataFrame:
    obs = _obs(spark, d)
    tag = lambda df, kind: df.select(*KEYS, "capture_seq", "monotonic_ns", F.lit(kind).alias("kind"), "price")
    streams = [tag(projections.trades(obs), "trade"), tag(obs.where("event_type = 'purchase'"), "book"), tag(obs.where("event_type = 'signup'"), "tick"), tag(projections.boundaries(obs), "boundary")]
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return checks.with_previous(out.withColumn("price", F.col("price").cast("double")), ["kind"], KEYS).select("capture_session_id", "symbol", "capture_seq", "monotonic_ns", "kind", "price", "prev_kind")


def _corrupt(obs: DataFrame) -> DataFrame:
    twisted = obs.withColumn("monotonic_ns", F.when(F.col("capture_seq") == 200, F.col("monotonic_ns") - F.lit(10**12)).otherwise(F.col("monotonic_ns")))
    return twisted.unionByName(obs.where("capture_seq = 100")).where("capture_seq <> 300")


def sequence_violations(spark: SparkSession, d: str) -> DataFrame:
    return checks.sequence_violations(_corrupt(_obs(spark, d)).select("capture_session_id", "capture_seq", "monotonic_ns"))


def trade_flow(spark: SparkSession, d: str) -> DataFrame:
    obs = _obs(spark, d)
    out = history.trade_flow(obs.where("event_type = 'signup'").select(*KEYS, "capture_seq", "monotonic_ns"), projections.trades(obs))
    names = [c for c in out.columns if c not in (*KEYS, "capture_seq", "monotonic_ns")]
    doubles = [c for c in names if not c.startswith("count")]
    return _round(out.withColumns({c: F.col(c).cast("double") for c in doubles}), doubles, 6)


def returns_backward(spark: SparkSession, d: str) -> DataFrame:
    out = history.backward_returns(projections.mids(_obs(spark, d)).select(*KEYS, "capture_seq", "monotonic_ns", "price"))
    return _round(out.drop("price"), [f"return_{h}" for h in history.RETURN_HORIZONS])


def realized_volatility(spark: SparkSession, d: str) -> DataFrame:
    out = history.realized_volatility(projections.mids(_obs(spark, d)).select(*KEYS, "capture_seq", "monotonic_ns", "price"))
    return _round(out.drop("price"), [f"realized_volatility_{w}" for w in history.WINDOWS])


def _features(spark: SparkSession, d: str) -> DataFrame:
    """Ticks with return, volatility, flow, clock offset and why a tick isn't valid."""
    obs = _obs(spark, d)
    base = projections.mids(obs).select(*KEYS, "capture_seq", "monotonic_ns", "price", "x", "k", "feature_valid")
    base = history.realized_volatility(history.backward_returns(base, {"1s": SECOND}), {"5s": 5 * SECOND})
    base = history.trade_flow(base, projections.trades(obs), {"1s": SECOND})
    clocked = clock.latest_before(base, clock.rolling_clock(projections.clock_samples(obs)), ["clock_offset_ms"])
    reasons = prices.invalid_reasons(
        invalid_tick=~F.col("feature_valid"), no_return=F.col("return_1s").isNull(), no_volatility=F.col("realized_volatility_5s").isNull(), no_trades=F.col("count_1s") == 0, no_clock=F.col("clock_offset_ms").isNull()
    )
    return clocked.withColumn("invalid_reasons", reasons)


def feature_table(spark: SparkSession, d: str) -> DataFrame:
    out = _features(spark, d).select(*KEYS, "capture_seq", "monotonic_ns", "return_1s", "realized_volatility_5s", "imbalance_1s", "count_1s", "clock_offset_ms", F.array_join("invalid_reasons", ",").alias("invalid_reasons"))
    return _round(out, ["return_1s", "realized_volatility_5s", "imbalance_1s", "clock_offset_ms"])


def forward_labels(spark: SparkSession, d: str) -> DataFrame:
    out = _labelled(spark, d, list(H)).select("capture_session_id", "symbol", "capture_seq", "monotonic_ns", *[f"future_return_{h}" for h in H])
    return _round(out, [f"future_return_{h}" for h in H])


def label_excursions(spark: SparkSession, d: str) -> DataFrame:
    names = [f"future_max_{s}_bps_{h}" for h in labels.EXCURSIONS for s in ("up", "down")]
    out = _labelled(spark, d, list(labels.EXCURSIONS), labels.EXCURSIONS).select(*KEYS, "capture_seq", *names)
    return _round(out, names, 6)


def feature_history_epochs(spark: SparkSession, d: str) -> DataFrame:
    """Returns and volatility on a clock of half seconds, where instants have several rows; boundaries start epochs."""
    obs = _obs(spark, d)
    coarse = projections.mids(obs).withColumn("monotonic_ns", F.expr("monotonic_ns div 500000000 * 500000000")).select(*KEYS, "capture_seq", "monotonic_ns", "price")
    keys = [*KEYS, "epoch"]
    rows = history.with_epochs(coarse, projections.boundaries(obs))
    rows = history.realized_volatility(history.backward_returns(rows, {"1s": SECOND, "5s": 5 * SECOND}, keys=keys), {"5s": 5 * SECOND}, keys=keys)
    return _round(rows.drop("price"), ["return_1s", "return_5s", "realized_volatility_5s"])


def civil_range_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of a civil range with holes: rows outside it end the labels that would reach them."""
    obs = _obs(spark, d)
    mids = projections.mids(obs).withColumn("inside", F.hour("ts").between(6, 17))
    out = labels.civil_range_labels(mids, F.col("inside"), projections.boundaries(obs), {h: H[h] for h in ("500ms", "1s")})
    return _round(out.select(*KEYS, "capture_seq", "future_return_500ms", "future_return_1s"), ["future_return_500ms", "future_return_1s"])


def segment_report(spark: SparkSession, d: str) -> DataFrame:
    """Per symbol, day, feature and horizon: correlations of all and of non-overlapping rows, and the edge at strong signals."""
    obs = _obs(spark, d)
    names = ["500ms", "1s"]
    rows = labels.forward_labels(history.backward_returns(projections.mids(obs), {"1s": SECOND}), projections.boundaries(obs), {h: H[h] for h in names}, ())
    rows = rows.where("feature_valid").withColumn("segment", F.date_format("ts", "yyyy-MM-dd"))
    out = stats.segment_report(rows.select(*KEYS, "segment", "capture_seq", "monotonic_ns", "x", "return_1s", *[f"future_return_{h}" for h in names]), ["x", "return_1s"], {h: H[h] for h in names}, directional=["x"])
    return _round(out, ["pearson", "spearman", "apart_pearson", "edge_bps"], 6)


def feature_label_join(spark: SparkSession, d: str) -> DataFrame:
    features = history.backward_returns(projections.mids(_obs(spark, d)), {"1s": SECOND}).select(*KEYS, "capture_seq", "monotonic_ns", "x", "return_1s")
    target = _labelled(spark, d, ["1s"]).select(*KEYS, "capture_seq", "future_return_1s")
    return _round(features.join(target, [*KEYS, "capture_seq"]).drop("capture_seq"), ["x", "return_1s", "future_return_1s"])


def feature_label_correlation(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: features and forward labels to correlations per feature and horizon, one row each."""
    obs = _obs(spark, d)
    rows = history.realized_volatility(history.backward_returns(projections.mids(obs), {"250ms": SECOND // 4, "1s": SECOND}), {"5s": 5 * SECOND})
    horizons = ("500ms", "1s", "5s")
    rows = labels.forward_labels(rows, projections.boundaries(obs), {h: H[h] for h in horizons}, ())
    return _round(stats.correlations(_tall(rows.where("feature_valid"), ["x", "return_250ms", "return_1s", "realized_volatility_5s"], horizons), ["symbol", "feature", "horizon"]), ["pearson", "spearman"], 8)


def _tall(rows: DataFrame, features: list[str], horizons: tuple[str, ...] | list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """symbol, feature, horizon, x, y: one row per observation, feature and horizon."""
    f = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("x")) for n in features])).alias("f")
    y = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"future_return_{h}").alias("y")) for h in horizons])).alias("l")
    one = rows.select("symbol", "capture_seq", "monotonic_ns", *extra, *[f"future_return_{h}" for h in horizons], f)
    return one.select("symbol", "capture_seq", "monotonic_ns", *extra, "f.feature", "f.x", y).select("symbol", "capture_seq", "monotonic_ns", *extra, "feature", "x", "l.horizon", "l.y")


def chronological_split(spark: SparkSession, d: str) -> DataFrame:
    parts = labels.chronological_split(projections.mids(_obs(spark, d)), H["10s"])
    return parts.groupBy(*KEYS, "part").agg(F.count(F.lit(1)).alias("rows"), F.min("monotonic_ns").alias("first_ns"), F.max("monotonic_ns").alias("last_ns"))


def _pairs(spark: SparkSession, d: str, horizon: str = "1s") -> DataFrame:
    """Valid observations: symbol, capture_seq, monotonic_ns, x, y."""
    return _labelled(spark, d, [horizon]).where("feature_valid").select(*KEYS, "capture_seq", "monotonic_ns", "ts", "x", F.col(f"future_return_{horizon}").alias("y"))


def corr_pearson_spearman(spark: SparkSession, d: str) -> DataFrame:
    return _round(stats.correlations(_pairs(spark, d), ["symbol"]), ["pearson", "spearman"])


def quantile_bins(spark: SparkSession, d: str) -> DataFrame:
    return _round(stats.quantile_bins(_pairs(spark, d), ["symbol"], "capture_seq"), ["min_x", "max_x", "mean_y", "std_y", "std_error"])


def hit_rates(spark: SparkSession, d: str) -> DataFrame:
    return _round(stats.hit_rates(_pairs(spark, d), ["symbol"]), ["threshold", "hit_rate"])


def data_quality_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = history.backward_returns(projections.mids(_obs(spark, d)), {"1s": SECOND, "10s": 10 * SECOND})
    return _round(stats.numeric_summary(rows, ["price", "qty", "x", "return_1s", "return_10s"]), ["min", "median", "p95", "p99", "max"])


def invariant_errors(spark: SparkSession, d: str) -> DataFrame:
    rules: dict[str, Column] = {"qty_small": F.col("qty") < 1, "signal_range": F.abs("x") > 0.99, "price_high": F.col("price") > 580, "invalid": ~F.col("feature_valid")}
    return checks.invariant_errors(projections.mids(_obs(spark, d)), rules)


def autocorrelation_grid(spark: SparkSession, d: str) -> DataFrame:
    rows = projections.mids(_obs(spark, d)).where("feature_valid")
    return _round(stats.autocorrelation(rows, ["symbol"], (250, 500, 1000, 2000, 5000)), ["acf"])


def moments_partial_final(spark: SparkSession, d: str) -> DataFrame:
    parts = stats.moments(_pairs(spark, d).withColumn("hour", F.date_trunc("hour", "ts")), ["symbol", "hour"])
    return _round(stats.merged_correlation(parts, ["symbol"]), ["correlation"])


def session_stability(spark: SparkSession, d: str) -> DataFrame:
    days = stats.correlations(_pairs(spark, d).withColumn("day", F.to_date("ts")), ["symbol", "day"])
    return _round(stats.stability(_round(days, ["pearson"]), ["symbol"], "pearson"), ["median", "min", "max", "same_sign"])


def vol_regime_corr(spark: SparkSession, d: str) -> DataFrame:
    obs = _obs(spark, d)
    rows = history.realized_volatility(projections.mids(obs), {"5s": 5 * SECOND})
    rows = labels.forward_labels(rows, projections.boundaries(obs), {"1s": SECOND}, ()).where("feature_valid").withColumnRenamed("future_return_1s", "y")
    rows = stats.volatility_regimes(_round(rows, ["realized_volatility_5s"]), ["symbol"], "realized_volatility_5s")
    return _round(stats.complete(rows).groupBy("symbol", "regime").agg(F.count(F.lit(1)).alias("n"), stats.pearson(F.col("x"), F.col("y")).alias("pearson")), ["pearson"])


def cost_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    signed = F.when(F.col("x") >= 0.6, F.col("y")).when(F.col("x") <= -0.6, -F.col("y")) * 10000
    edges = _pairs(spark, d).groupBy("symbol").agg(F.round(F.avg(signed), 9).alias("edge_bps"), F.count(signed).alias("n"))
    return _round(stats.cost_sensitivity(edges), ["edge_bps", "net_bps", "edge_to_cost", "break_even_bps", "cost_bps"], 6)


def _signal_features(spark: SparkSession, d: str) -> DataFrame:
    obs = _obs(spark, d)
    base = projections.mids(obs).select(*KEYS, "capture_seq", "monotonic_ns", "price", "feature_valid", "x", "k")
    flow = history.trade_flow(base, projections.trades(obs), {"1s": SECOND})
    return flow.select(
        *KEYS,
        "capture_seq",
        "monotonic_ns",
        "feature_valid",
        F.col("price").alias("mid_price"),
        (F.lit(1.0) + F.col("k") / F.lit(100.0)).alias("spread_bps"),
        (F.col("x") / F.lit(10.0)).alias("microprice_offset_bps"),
        F.col("x").alias("imbalance_l1"),
        F.col("x").alias("imbalance_l5"),
        F.col("imbalance_1s").alias("trade_imbalance_1s"),
    )


def signals_all(spark: SparkSession, d: str) -> DataFrame:
    return _round(signals.all_signals(_signal_features(spark, d)).drop("evidence"), ["score"])


def strategy_edges(spark: SparkSession, d: str) -> DataFrame:
    fired = signals.all_signals(_signal_features(spark, d)).select(*KEYS, "capture_seq", "strategy", "side")
    target = _labelled(spark, d, ["1s", "5s"])
    both = fired.join(target.select(*KEYS, "capture_seq", F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"future_return_{h}").alias("y")) for h in ("1s", "5s")])).alias("l")), [*KEYS, "capture_seq"])
    edge = F.when(F.col("side") == "LONG", F.col("l.y")).otherwise(-F.col("l.y")) * 10000
    return _round(both.where("l.y is not null").groupBy("strategy", F.col("l.horizon").alias("horizon")).agg(F.count(F.lit(1)).alias("n"), F.avg(edge).alias("edge_bps")), ["edge_bps"], 6)


def nonoverlap_samples(spark: SparkSession, d: str) -> DataFrame:
    return signals.non_overlapping(projections.mids(_obs(spark, d)).select(*KEYS, "capture_seq", "monotonic_ns"), H["5s"])


_SHADOW_RULE = signals.RULES[1]
_COSTS = signals.Costs(maker_fee_bps=1.0, taker_fee_bps=2.0, entry_slippage_bps=0.5, exit_slippage_bps=0.5)


def _trades(spark: SparkSession, d: str) -> DataFrame:
    return signals.priced(signals.shadow_positions(_signal_features(spark, d), _SHADOW_RULE, SECOND), _COSTS)


def shadow_trades(spark: SparkSession, d: str) -> DataFrame:
    names = ["entry_mid", "exit_mid", "gross_pnl", "fees", "slippage_cost", "net_pnl", "mfe_bps", "mae_bps", "holding_time_ms"]
    return _round(_trades(spark, d).select("symbol", "strategy", "side", "entry_ns", "exit_ns", *names), names, 6)


def strategy_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = signals.strategy_metrics(_trades(spark, d), ["symbol", "strategy"])
    whole = {"symbol", "strategy", "trade_count", "long_count", "short_count", "maximum_consecutive_losses"}
    return _round(out, [c for c in out.columns if c not in whole], 5)


def block_preaggregate(spark: SparkSession, d: str) -> DataFrame:
    return _round(stats.block_sums(stats.complete(_pairs(spark, d)), ["symbol"]), ["high_sum", "low_sum"], 6)


def block_bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    return _round(stats.block_bootstrap(stats.block_sums(stats.complete(_pairs(spark, d)), ["symbol"]), ["symbol"]), ["estimate", "low", "high"])


def effective_sample_size(spark: SparkSession, d: str) -> DataFrame:
    return _round(stats.effective_sample_size(projections.mids(_obs(spark, d)).where("feature_valid"), ["symbol"], "capture_seq"), ["ess"], 6)


def rolling_clock_median(spark: SparkSession, d: str) -> DataFrame:
    out = clock.rolling_clock(projections.clock_samples(_obs(spark, d)))
    names = ["clock_offset_ms", "clock_rtt_ms", "clock_min_rtt_ms", "clock_drift_ms", "clock_mad_ms"]
    return _round(out.select(*KEYS, "capture_seq", "clock_samples", *names), names, 6)


def _lagged(spark: SparkSession, d: str) -> DataFrame:
    obs = _obs(spark, d)
    rows = projections.trades(obs).select(*KEYS, "capture_seq", "monotonic_ns", F.col("qty").cast("double").alias("raw_lag_ms"))
    rows = clock.latest_before(rows, clock.rolling_clock(projections.clock_samples(obs)), ["clock_offset_ms"])
    return rows.withColumn("corrected_lag_ms", F.col("raw_lag_ms") + F.col("clock_offset_ms"))


def clock_asof_lag(spark: SparkSession, d: str) -> DataFrame:
    return _round(_lagged(spark, d), ["raw_lag_ms", "clock_offset_ms", "corrected_lag_ms"], 6)


def top50_latency(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report: the 50 largest corrected lags of each series."""
    rows = _round(_lagged(spark, d), ["corrected_lag_ms"], 6).where("corrected_lag_ms is not null")
    w = Window.partitionBy(*KEYS).orderBy(F.col("corrected_lag_ms").desc(), "capture_seq")
    return rows.withColumn("place", F.row_number().over(w)).where("place <= 50").select(*KEYS, "capture_seq", "corrected_lag_ms", "place")


def latency_distribution(spark: SparkSession, d: str) -> DataFrame:
    rows = clock.intervals(projections.trades(_obs(spark, d)).select(*KEYS, "capture_seq", "monotonic_ns"))
    return _round(clock.recent_summary(rows, "interval_ms", KEYS), ["mean", "max", "p50", "p95", "p99"], 6)


def heartbeat_interval_join(spark: SparkSession, d: str) -> DataFrame:
    obs = _obs(spark, d)
    left = obs.where("event_type = 'purchase' and k >= 90").select(*KEYS, "capture_seq", "monotonic_ns")
    beats = obs.where("event_type = 'signup'").select(*KEYS, "capture_seq", "monotonic_ns", F.col("k").cast("double").alias("lag_ms"))
    return clock.interval_latest(left, beats, F.lit(1000.0) + F.col("r_value"), 1100, "lag_ms")


def hour_fragments(spark: SparkSession, d: str) -> DataFrame:
    rolled = _obs(spark, d).withColumn("ts", F.when(F.col("k") == 7, F.col("ts") - F.expr("interval 2 hours")).otherwise(F.col("ts")))
    out = clock.hour_fragments(rolled)
    return out.groupBy(*KEYS, "fragment").agg(F.min("capture_seq").alias("first_seq"), F.max("capture_seq").alias("last_seq"), F.count(F.lit(1)).alias("rows"))


def wallclock_backsteps(spark: SparkSession, d: str) -> DataFrame:
    rolled = _obs(spark, d).withColumn("ts", F.when(F.col("k") == 7, F.col("ts") - F.expr("interval 2 hours")).otherwise(F.col("ts")))
    return _round(clock.wall_clock_steps(rolled), ["largest_ms"], 3)


def emission_grid(spark: SparkSession, d: str) -> DataFrame:
    rows = projections.mids(_obs(spark, d)).select(*KEYS, "capture_seq", "monotonic_ns")
    return history.emission_grid(rows, SECOND, F.lit(0)).select(*KEYS, "slot", "capture_seq", "monotonic_ns")


def emit_on_change(spark: SparkSession, d: str) -> DataFrame:
    return clock.emit_on_change(_obs(spark, d).select(*KEYS, "capture_seq", "event_type"), ["event_type"])


def book_fold_topn(spark: SparkSession, d: str) -> DataFrame:
    obs = _obs(spark, d)
    updates = obs.select(*KEYS, "capture_seq", F.when(F.col("k") % 2 == 0, "bid").otherwise("ask").alias("side"), F.round(F.col("price"), 0).cast("bigint").alias("price"), F.when(F.col("event_type") == "error", 0).otherwise(F.col("k") + 1).alias("quantity"))
    return book.last_levels(updates, KEYS).select(*KEYS, "side", "level", "price", "quantity")


def catalog_overlap_selection(spark: SparkSession, d: str) -> DataFrame:
    """Orders as files of sessions (customers): sessions that overlap a month, whole."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    files = orders.select(F.col("o_custkey").cast("string").alias("capture_session_id"), F.concat(F.lit("SYM"), (F.col("o_orderkey") % 4).cast("string")).alias("symbol"), F.col("o_orderkey").alias("file_id"), F.col("o_orderdate").alias("start_local_time"), (F.col("o_orderdate") + F.expr("interval 7 days")).alias("end_local_time"))
    start, end = F.to_timestamp_ntz(F.lit("1996-03-01 00:00:00")), F.to_timestamp_ntz(F.lit("1996-04-01 00:00:00"))
    return catalog.select_sessions(files, "sym1", start, end).select("capture_session_id", "symbol", "file_id")


def dataset_rollup(spark: SparkSession, d: str) -> DataFrame:
    obs = _obs(spark, d)
    seconds = (F.max("monotonic_ns") - F.min("monotonic_ns")) / 1e9
    out = obs.groupBy("symbol", "event_type").agg(F.count(F.lit(1)).alias("rows"), F.min("capture_seq").alias("first_seq"), F.max("capture_seq").alias("last_seq"), (F.count(F.lit(1)) / seconds).alias("rate_per_s"), F.countDistinct("k").alias("kinds"))
    return _round(out, ["rate_per_s"], 6)


def replay_differences(spark: SparkSession, d: str) -> DataFrame:
    """Recomputed against recorded features, where some recorded ones are off."""
    actual = history.backward_returns(projections.mids(_obs(spark, d)), {"1s": SECOND}).select(*KEYS, "capture_seq", "price", "return_1s")
    recorded = actual.withColumns({"price": F.when(F.col("capture_seq") % 97 == 0, F.col("price") + F.lit(1)).otherwise(F.col("price")).cast("decimal(18,8)"), "return_1s": F.when(F.col("capture_seq") % 89 == 0, F.col("return_1s") + 1e-9).otherwise(F.col("return_1s"))})
    out = checks.field_differences(actual, recorded, [*KEYS, "capture_seq"], ["price"], ["return_1s"])
    return out.select(*KEYS, "capture_seq", F.array_join("differs", ",").alias("differs"))


def tumbling_counts_stream(spark: SparkSession, d: str) -> DataFrame:
    return counts.tumbling_counts(_obs(spark, d)).select("symbol", F.unix_seconds("window_start").alias("window_start_s"), "rows", F.round(F.col("volume").cast("double"), 6).alias("volume"))


def segment_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Per symbol: median and p95-like spread, share of unchanged ticks."""
    rows = _signal_features(spark, d).select(*KEYS, "capture_seq", "mid_price", "spread_bps")
    prev = checks.with_previous(rows, ["mid_price"], KEYS)
    placed = series.ranked(prev, ["spread_bps", "capture_seq"], ["symbol"])
    out = placed.groupBy("symbol").agg(
        stats.middle(placed, "spread_bps").alias("median_spread_bps"), stats.low_quantile(placed, 0.95, "spread_bps").alias("p95_spread_bps"), F.avg((F.col("mid_price") == F.col("prev_mid_price")).cast("double")).alias("unchanged_fraction")
    )
    return _round(out, ["median_spread_bps", "p95_spread_bps", "unchanged_fraction"])


def resource_slope(spark: SparkSession, d: str) -> DataFrame:
    rows = _obs(spark, d).select("symbol", (F.col("monotonic_ns") / 1e9).alias("t"), F.col("qty").cast("double").alias("v"))
    return _round(stats.least_squares_slope(rows, ["symbol"], "t", "v"), ["slope"], 7)
