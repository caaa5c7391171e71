"""What a segment's report says besides its correlations, in long form: one row a finding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import shared_table
from tidemark.sources.projections import KEYS

from . import signals, stats
from .checks import with_previous
from .series import ranked
from .spacing import non_overlapping

REGIMES = ("LOW", "MEDIUM", "HIGH")
LAGS_MS = (250, 500, 1000, 2000, 5000)


def _finding(df: DataFrame, keys: list[str], part: str | Column, item: Column | str, n: Column | str, value: Column | str | None) -> DataFrame:
    """The rows of one part; features and horizons it hasn't got are null."""
    has = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    as_col = lambda x: F.lit(None) if x is None else F.col(x) if isinstance(x, str) else x
    part = F.lit(part) if isinstance(part, str) else part
    return df.select(*keys, "segment", has("feature").alias("feature"), has("horizon").alias("horizon"), part.alias("part"), as_col(item).cast("string").alias("item"), as_col(n).cast("bigint").alias("n"), as_col(value).cast("double").alias("value"))


def _long(rows: DataFrame, keys: list[str], features: list[str], horizons: list[str]) -> DataFrame:
    x = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("f")
    y = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"future_return_{h}").cast("double").alias("y")) for h in horizons])).alias("h")
    own = [c for c in (*keys, "segment", "capture_seq", "monotonic_ns", "regime") if c in rows.columns]
    return rows.select(*own, x, *[f"future_return_{h}" for h in horizons]).select(*own, "f.*", y).select(*own, "feature", "x", "h.*")


def _effective(spaced: DataFrame, group: list[str]) -> DataFrame:
    """The smaller of both variables' effective counts over complete pairs of rows a horizon apart."""
    sides = F.explode(F.array(F.struct(F.lit("x").alias("of"), F.col("x").alias("v")), F.struct(F.lit("y").alias("of"), F.col("y").alias("v")))).alias("s")
    tall = stats.complete(spaced).select(*group, "capture_seq", sides).select(*group, "capture_seq", "s.*")
    each = stats.effective_sample_size(tall, [*group, "of"], "capture_seq", "v")
    return each.groupBy(*group).agg(F.max("n").alias("n"), F.min("ess").alias("ess"))


def segment_details(rows: DataFrame, features: list[str], horizons: dict[str, int], directional: list[str], volatility: str, keys: list[str] = KEYS, costs: tuple[float, ...] = stats.COST_GRID) -> DataFrame:
    """keys, segment, feature, horizon, part, item, n, value.

    ``rows``: keys, segment, capture_seq, monotonic_ns, feature_valid, the features, ``future_return_<h>``, ``volatility``, spread_bps, mid_price, and what the
    signal rules read.  Only valid rows count, but for ``comparison``.  Parts:

    * effective: effective count of pairs on rows a horizon apart (n: pairs)
    * bin_mean, bin_error: mean and standard error of the return in each of ten bins of the signal (item: bin)
    * signal_acf, return_acf: autocorrelation at each lag in ms (item)
    * regime_cut: the volatility's cuts; regime: correlation in each regime (item)
    * edge_net: signed return at signals of 0.6 and more of ``directional`` features, less each cost (item)
    * strategy_net: the same for each signal rule (item: rule and cost)
    * comparison: medians, the 95 % spread, valid rows and the share of unchanged mids (item)
    """
    segment = [*keys, "segment"]
    group = [*segment, "feature", "horizon"]
    every = shared_table(rows, "report-rows")
    valid = stats.volatility_regimes(every.where("feature_valid"), segment, volatility)
    valid = shared_table(valid, "report-valid")
    long = shared_table(_long(valid, keys, features, list(horizons)), "report-long")
    # what follows reads these more than once; a spaced row takes along only what its pairs need
    few = lambda h, ns: non_overlapping(valid.select(*segment, "capture_seq", "monotonic_ns", *features, f"future_return_{h}"), ns, segment)
    spaced = shared_table(reduce(DataFrame.unionByName, [_long(few(h, ns), keys, features, [h]) for h, ns in horizons.items()]), "report-spaced")
    effective = _effective(spaced, group)
    bins = shared_table(stats.quantile_bins(long, group, "capture_seq"), "report-bins")
    signal_rows = long.where(F.col("horizon") == next(iter(horizons))).drop("horizon")
    return_rows = long.where(F.col("feature") == features[0]).drop("feature")
    acf = stats.autocorrelation(signal_rows, [*segment, "feature"], LAGS_MS, bridge_nulls=False)
    return_acf = stats.autocorrelation(return_rows, [*segment, "horizon"], LAGS_MS, value="y", bridge_nulls=False)
    regimes = stats.complete(long).where(F.col("regime").isin(*REGIMES)).groupBy(*group, "regime").agg(F.count(F.lit(1)).alias("n"), stats.pearson(F.col("x"), F.col("y")).alias("r"))
    cuts = valid.where("regime in ('LOW', 'MEDIUM')").groupBy(*segment, "regime").agg(F.max(volatility).alias("cut"), F.count(F.lit(1)).alias("n"))
    signed = F.when(F.col("x") >= 0.6, F.col("y")).when(F.col("x") <= -0.6, -F.col("y")) * 10_000
    edges = stats.complete(long).where(F.col("feature").isin(directional)).groupBy(*group).agg(F.avg(signed).alias("edge_bps"), F.count(signed).alias("n"))
    fired = signals.all_signals(valid, signals.RULES, ("segment", *[f"future_return_{h}" for h in horizons]))
    after = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"future_return_{h}").cast("double").alias("y")) for h in horizons])).alias("h")
    moved = fired.select(*segment, "strategy", "side", after).select(*segment, "strategy", "side", "h.*")
    moved = moved.groupBy(*segment, "horizon", "strategy").agg(F.avg(F.when(F.col("side") == "LONG", F.col("y")).otherwise(-F.col("y")) * 10_000).alias("edge_bps"), F.count("y").alias("n"))
    priced = lambda df: stats.cost_sensitivity(df, costs=costs)
    cost = F.col("cost_bps").cast("string")
    parts = [
        _finding(effective, keys, "effective", F.lit(None), "n", "ess"),
        _finding(bins, keys, "bin_mean", "bin", "count", "mean_y"),
        _finding(bins, keys, "bin_error", "bin", "count", "std_error"),
        _finding(acf, keys, "signal_acf", "lag_ms", "n", "acf"),
        _finding(return_acf, keys, "return_acf", "lag_ms", "n", "acf"),
        _finding(cuts, keys, "regime_cut", "regime", "n", "cut"),
        _finding(regimes, keys, "regime", "regime", "n", "r"),
        _finding(priced(edges.where("n > 0")), keys, "edge_net", cost, "n", "net_bps"),
        _finding(priced(moved.where("n > 0")), keys, "strategy_net", F.concat_ws(" ", "strategy", cost), "n", "net_bps"),
        _comparison(every, valid, keys, volatility),
    ]
    return reduce(DataFrame.unionByName, parts)


def _comparison(every: DataFrame, valid: DataFrame, keys: list[str], volatility: str) -> DataFrame:
    segment = [*keys, "segment"]
    measured = [every.select(*segment, F.lit("spread_bps").alias("of"), F.col("spread_bps").cast("double").alias("v")), valid.select(*segment, F.lit(volatility).alias("of"), F.col(volatility).cast("double").alias("v"))]
    placed = ranked(reduce(DataFrame.unionByName, measured).where("v is not null"), ["v"], [*segment, "of"])
    medians = shared_table(placed.groupBy(*segment, "of").agg(F.max("n").alias("n"), stats.middle(placed, "v").alias("median"), stats.low_quantile(placed, 0.95, "v").alias("p95")), "report-medians")
    prev = with_previous(every.select(*segment, "capture_seq", "mid_price", "feature_valid"), ["mid_price"], segment)
    counts = shared_table(prev.groupBy(*segment).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("feature_valid").cast("int")).alias("valid"), (F.count_if(F.col("mid_price") == F.col("prev_mid_price")) / F.greatest(F.lit(1), F.count(F.lit(1)) - 1)).alias("unchanged")), "report-counts")
    return reduce(
        DataFrame.unionByName,
        [
            _finding(medians, keys, "comparison", F.concat(F.lit("median_"), "of"), "n", "median"),
            _finding(medians.where("of = 'spread_bps'"), keys, "comparison", F.lit("p95_spread_bps"), "n", "p95"),
            _finding(counts, keys, "comparison", F.lit("valid"), "n", "valid"),
            _finding(counts, keys, "comparison", F.lit("unchanged_fraction"), "n", "unchanged"),
        ],
    )
