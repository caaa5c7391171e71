"""Dependence-aware statistics over long tables of (group, x, y)."""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_table
from tidemark.sources.projections import KEYS

from .series import SECOND, average_ranks, chunk_window, chunked, ranked, upto
from .spacing import non_overlapping

TOLERANCE_NS = 150_000_000
COST_GRID = (0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0, 7.5, 10.0)


def complete(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Pairs without nulls, NaN or infinities."""
    fine = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c)) & (F.abs(F.col(c)) != F.lit(float("inf")))
    return df.where(fine(x) & fine(y))


def pearson(x: Column, y: Column) -> Column:
    """Correlation of complete pairs; NULL below two rows or without variance (`corr` itself divides by zero there)."""
    scale = F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y))
    return F.when(F.count(x) >= 2, F.try_divide(F.covar_pop(x, y), scale))


def correlations(df: DataFrame, keys: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """keys, n, pearson, spearman (average ranks for ties)."""
    pairs = shared_table(complete(df, x, y).select(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")), "pairs")
    both = pairs.join(average_ranks(pairs, "x", keys, "rx"), [*keys, "x"]).join(average_ranks(pairs, "y", keys, "ry"), [*keys, "y"])
    return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), pearson(F.col("x"), F.col("y")).alias("pearson"), pearson(F.col("rx"), F.col("ry")).alias("spearman"))


def segment_report(rows: DataFrame, features: list[str], horizons: dict[str, int], directional: list[str], keep: float = 0.6, keys: list[str] = KEYS) -> DataFrame:
    """A row per keys, ``segment``, feature and horizon with complete pairs.

    ``rows``: keys, segment, capture_seq, monotonic_ns, the features and ``future_return_<h>``.  Returned are n, pearson and
    spearman of all pairs; apart_n and apart_pearson of those on rows at least a horizon apart (chosen before
    pairs without a value go); signal_n and edge_bps, the mean signed return at signals beyond ``keep``, where the feature
    is ``directional``.
    """
    group = [*keys, "segment", "feature", "horizon"]
    rows = shared_table(rows, "segment-rows")

    def tall(of: DataFrame, name: str) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("f")
        return of.select(*keys, "segment", F.col(f"future_return_{name}").alias("y"), F.lit(name).alias("horizon"), each).select(*keys, "segment", "horizon", "f.feature", "f.x", "y")

    every, apart = None, None
    for name, ns in horizons.items():
        one = tall(rows, name)
        few = tall(non_overlapping(rows, ns, [*keys, "segment"]), name)
        every, apart = (one, few) if every is None else (every.unionByName(one), apart.unionByName(few))
    whole = correlations(every, group)
    spaced = complete(apart).groupBy(*group).agg(F.count(F.lit(1)).alias("apart_n"), pearson(F.col("x"), F.col("y")).alias("apart_pearson"))
    signed = F.when(F.col("x") >= keep, F.col("y")).when(F.col("x") <= -keep, -F.col("y")) * 10_000
    edges = complete(every).where(F.col("feature").isin(directional)).groupBy(*group).agg(F.count(signed).alias("signal_n"), F.avg(signed).alias("edge_bps"))
    return whole.join(spaced, group, "left").join(edges, group, "left").withColumn("apart_n", F.coalesce("apart_n", F.lit(0)))


def quantile_bins(df: DataFrame, keys: list[str], tie: str, bins: int = 10, x: str = "x", y: str = "y") -> DataFrame:
    """Equal-count bins of x in source order for ties: count, range of x, mean, deviation and error of y."""
    placed = ranked(complete(df, x, y).select(*keys, tie, x, y), [x, tie], keys).withColumn("bin", F.expr(f"(rn * {bins} - 1) div n"))
    out = placed.groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("count"), F.min(x).alias("min_x"), F.max(x).alias("max_x"), F.avg(y).alias("mean_y"), F.stddev_samp(y).alias("std_y")
    )
    return out.withColumn("std_error", F.col("std_y") / F.sqrt("count"))


def hit_rates(df: DataFrame, keys: list[str], thresholds: tuple[float, ...] = (0.2, 0.4, 0.6), x: str = "x", y: str = "y") -> DataFrame:
    """keys, threshold, direction, count and share of labels with the signal's sign."""
    grid = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(d).alias("direction")) for t in thresholds for d in ("LONG", "SHORT")])).alias("g")
    long_, short = F.col("g.direction") == "LONG", F.col("g.direction") == "SHORT"
    on = (long_ & (F.col(x) >= F.col("g.threshold"))) | (short & (F.col(x) <= -F.col("g.threshold")))
    right = (long_ & (F.col(y) > 0)) | (short & (F.col(y) < 0))
    out = complete(df, x, y).select(*keys, x, y, grid).groupBy(*keys, F.col("g.threshold").alias("threshold"), F.col("g.direction").alias("direction"))
    return out.agg(F.sum(on.cast("long")).alias("count"), F.sum((on & right).cast("long")).alias("hits")).withColumn("hit_rate", F.when(F.col("count") > 0, F.col("hits") / F.col("count")))


def low_quantile(placed: DataFrame, q: float, value: str) -> Column:
    """Aggregate: the value at index floor((n - 1) * q) of a ``ranked`` table."""
    return F.max(F.when(F.col("rn") == F.floor((F.col("n") - 1) * F.lit(q)) + 1, F.col(value)))


def middle(placed: DataFrame, value: str) -> Column:
    """Aggregate: the median of a ``ranked`` table, from its middle places."""
    return F.avg(F.when((F.col("rn") == F.expr("(n + 1) div 2")) | (F.col("rn") == F.expr("(n + 2) div 2")), F.col(value)))


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """name, rows, missing, nan, inf, min, median, p95, p99, max of each column; quantiles of low rank."""
    tall = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns])).alias("e")).select("e.*")
    inf = F.abs(F.col("v")) == F.lit(float("inf"))
    fine = F.col("v").isNotNull() & ~F.isnan("v") & ~inf
    base = tall.groupBy("name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("v").isNull().cast("long")).alias("missing"), F.sum(F.coalesce(F.isnan("v"), F.lit(False)).cast("long")).alias("nan"), F.sum(F.coalesce(inf, F.lit(False)).cast("long")).alias("inf")
    )
    placed = ranked(tall.where(fine), ["v"], ["name"])
    own = placed.groupBy("name").agg(
        F.min("v").alias("min"), middle(placed, "v").alias("median"), low_quantile(placed, 0.95, "v").alias("p95"), low_quantile(placed, 0.99, "v").alias("p99"), F.max("v").alias("max")
    )
    return base.join(own, "name", "left")


def autocorrelation(df: DataFrame, keys: list[str], lags_ms: tuple[int, ...], value: str = "x", bridge_nulls: bool = True) -> DataFrame:
    """keys, lag_ms, n, acf: correlation with the latest earlier value at least the lag and at most 150 ms more ago.

    Rows without a value are passed over; with ``bridge_nulls`` off, one that is the latest earlier row leaves the pair out.
    """
    tall = df.select(*keys, "monotonic_ns", "capture_seq", F.col(value).cast("double").alias("v"))
    tall = tall.where("v is not null") if bridge_nulls else tall
    cut = chunked(tall, max(lags_ms) * 1_000_000 + TOLERANCE_NS, 0)
    # of rows of one instant the last one captured stands for it
    w = chunk_window(keys)
    last = F.row_number().over(Window.partitionBy(*keys, "chunk", "monotonic_ns").orderBy(F.col("capture_seq").desc())) == 1
    cut = cut.withColumn("__row", F.when(last, F.struct(F.col("monotonic_ns").alias("ns"), "v")))
    lagged = {}
    for m in lags_ms:
        old = F.last("__row", ignorenulls=True).over(upto(w, -m * 1_000_000))
        lagged[f"__{m}"] = F.when(old["ns"] >= F.col("monotonic_ns") - (m * 1_000_000 + TOLERANCE_NS), old["v"])
    cut = cut.withColumns(lagged).where("home")
    pairs = cut.select(*keys, "v", F.explode(F.array(*[F.struct(F.lit(m).alias("lag_ms"), F.col(f"__{m}").alias("p")) for m in lags_ms])).alias("e")).select(*keys, "v", "e.*").where("v is not null and p is not null")
    return pairs.groupBy(*keys, "lag_ms").agg(F.count(F.lit(1)).alias("n"), pearson(F.col("v"), F.col("p")).alias("acf"))


def moments(df: DataFrame, keys: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Mergeable centred moments of complete pairs."""
    return complete(df, x, y).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), (F.var_pop(x) * F.count(F.lit(1))).alias("sxx"), (F.var_pop(y) * F.count(F.lit(1))).alias("syy"), (F.covar_pop(x, y) * F.count(F.lit(1))).alias("sxy")
    )


def merged_correlation(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Correlation from partial moments: NULL below three rows, clamped to [-1, 1].

    Parts are merged by their deviations from the merged means, which don't cancel where means are large against the spread.
    """
    n = F.sum("n")
    means = parts.groupBy(*keys).agg(*[(F.sum(F.col("n") * F.col(m)) / n).alias(f"__{m}") for m in ("mx", "my")])
    both = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    on = means.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    apart = parts.join(on, both).withColumns({"__dx": F.col("mx") - F.col("__mx"), "__dy": F.col("my") - F.col("__my")})
    spread = lambda own, a, b: F.sum(F.col(own) + F.col("n") * F.col(a) * F.col(b))
    out = apart.groupBy(*keys).agg(n.alias("n"), spread("sxx", "__dx", "__dx").alias("__xx"), spread("syy", "__dy", "__dy").alias("__yy"), spread("sxy", "__dx", "__dy").alias("__xy"))
    r = F.try_divide(F.col("__xy"), F.sqrt(F.col("__xx")) * F.sqrt(F.col("__yy")))
    return out.select(*keys, "n", F.when((F.col("n") >= 3) & (F.col("__xx") > 0) & (F.col("__yy") > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("correlation"))


def stability(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Over sessions or segments: usable count, median, extremes, share with the median's sign."""
    base = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.count(value).alias("usable"), F.percentile(value, 0.5).alias("median"), F.min(value).alias("min"), F.max(value).alias("max"))
    both = df.join(base.select(*keys, "median"), keys)
    same = both.groupBy(*keys).agg(F.avg(F.when(F.col(value).isNotNull(), (F.signum(value) == F.signum("median")).cast("double"))).alias("same_sign"))
    return base.join(same, keys)


def volatility_regimes(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``df`` with ``regime`` by cuts at the lower and upper third of the present values."""
    placed = ranked(df.where(F.col(value).isNotNull()).select(*keys, value), [value], keys)
    third = lambda k: F.max(F.when(F.col("rn") == F.expr(f"({k} * (n - 1)) div 3") + 1, F.col(value)))
    cuts = placed.groupBy(*keys).agg(third(1).alias("__c0"), third(2).alias("__c1"))
    v = F.col(value)
    regime = F.when(v.isNull(), "UNAVAILABLE").when(v <= F.col("__c0"), "LOW").when(v <= F.col("__c1"), "MEDIUM").otherwise("HIGH")
    return df.join(cuts, keys, "left").withColumn("regime", regime).drop("__c0", "__c1")


def cost_sensitivity(df: DataFrame, edge: str = "edge_bps", costs: tuple[float, ...] = COST_GRID) -> DataFrame:
    """A row per cost: net edge, edge to cost (NULL at 0), break-even cost."""
    out = df.withColumn("cost_bps", F.explode(F.array(*[F.lit(c) for c in costs])))
    return out.withColumns({"net_bps": F.col(edge) - F.col("cost_bps"), "edge_to_cost": F.when(F.col("cost_bps") != 0, F.col(edge) / F.col("cost_bps")), "break_even_bps": F.col(edge)})


def block_sums(df: DataFrame, keys: list[str], block_ns: int = 10 * SECOND, threshold: float = 0.6, x: str = "x", y: str = "y") -> DataFrame:
    """Per block of time, anchored at the first row: rows, and sum (bps) and count of y above and below the threshold of x."""
    first = df.groupBy(*keys).agg(F.min("monotonic_ns").alias("__first"))
    cut = df.join(first, keys).withColumn("block", F.expr(f"(monotonic_ns - __first) div {block_ns}"))
    high, low = F.col(x) >= threshold, F.col(x) <= -threshold
    return cut.groupBy(*keys, "block").agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.when(high, F.col(y) * 10000)), F.lit(0.0)).alias("high_sum"),
        F.sum(F.coalesce(high.cast("long"), F.lit(0))).alias("high_count"),
        F.coalesce(F.sum(F.when(low, F.col(y) * 10000)), F.lit(0.0)).alias("low_sum"),
        F.sum(F.coalesce(low.cast("long"), F.lit(0))).alias("low_count"),
    )


def block_bootstrap(blocks: DataFrame, keys: list[str], replications: int = 200, seed: int = 42, difference: bool = False) -> DataFrame:
    """keys, block_count, estimate, low, high, draws: mean label above the threshold (minus the one below, if
    ``difference``) and its 95 % interval over resampled time blocks.

    ``blocks`` comes from ``block_sums``, so a group holds a row per block of time, not per observation.  Draws
    without a denominator are dropped; fewer than two blocks have no interval.
    """
    sums = ["high_sum", "high_count", "low_sum", "low_count"]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        table = pdf.sort_values("block")[sums].to_numpy(dtype=float)
        n = len(table)

        def ratio(total: np.ndarray) -> float | None:
            if not total[1] or (difference and not total[3]):
                return None
            return float(total[0] / total[1] - (total[2] / total[3] if difference else 0.0))

        draws = []
        if n >= 2:
            # the generator's sequence of draws is part of the definition
            rng = random.Random(seed)
            picks = np.array([rng.randrange(n) for _ in range(n * replications)]).reshape(replications, n)
            draws = sorted(v for v in map(ratio, table[picks].sum(axis=1)) if v is not None)
        at = lambda q: draws[int((len(draws) - 1) * q)] if draws else None
        row = [*(pdf[k].iloc[0] for k in keys), n, ratio(table.sum(axis=0)), at(0.025), at(0.975), len(draws)]
        return pd.DataFrame([row], columns=[*keys, "block_count", "estimate", "low", "high", "draws"])

    schema = ", ".join(f"{k} {blocks.schema[k].dataType.simpleString()}" for k in keys)
    return blocks.select(*keys, "block", *sums).groupBy(*keys).applyInPandas(one, f"{schema}, block_count bigint, estimate double, low double, high double, draws bigint")


def hashed_draw(replication: Column, place: Column, n: Column) -> Column:
    """A block's number below ``n``, by a hash of the draw's own numbers."""
    return F.pmod(F.xxhash64(replication, place), n)


def resampled(blocks: DataFrame, keys: list[str], replications: int = 200, difference: bool = False, draw: Callable[[Column, Column, Column], Column] = hashed_draw) -> DataFrame:
    """`block_bootstrap` as joins, for groups of any number of blocks: keys, block_count, estimate, low, high, draws.

    ``draw`` gives the number of the block that stands at a place of a replication, from the replication, the place and the number of blocks.
    """
    sums = ["high_sum", "high_count", "low_sum", "low_count"]
    placed = shared_table(ranked(blocks.select(*keys, "block", *sums), ["block"], keys).withColumn("place", F.col("rn") - 1), "bootstrap-blocks")
    share = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b))
    ratio = share("high_sum", "high_count") - (share("low_sum", "low_count") if difference else F.lit(0.0))
    totals = lambda df, by: df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums])
    whole = totals(placed, keys).select(*keys, ratio.alias("estimate")).join(placed.groupBy(*keys).agg(F.max("n").alias("block_count")), keys)
    each = placed.where("n >= 2").select(*keys, "place", "n", F.explode(F.sequence(F.lit(0), F.lit(replications - 1))).alias("replication"))
    picks = each.select(*keys, "replication", draw(F.col("replication"), F.col("place"), F.col("n")).cast("bigint").alias("place"))
    # equal picks are counted first, so a block is joined once a replication
    picks = picks.groupBy(*keys, "replication", "place").agg(F.count(F.lit(1)).alias("times"))
    drawn = picks.join(placed.select(*keys, "place", *sums), [*keys, "place"]).select(*keys, "replication", *[(F.col(c) * F.col("times")).alias(c) for c in sums])
    values = totals(drawn, [*keys, "replication"]).select(*keys, ratio.alias("v")).where("v is not null")
    # a value for each replication
    lists = values.groupBy(*keys).agg(F.sort_array(F.collect_list("v")).alias("l"))
    at = lambda q: F.get("l", F.floor((F.size("l") - 1) * q).cast("int"))
    return whole.join(lists, keys, "left").select(*keys, "block_count", "estimate", at(0.025).alias("low"), at(0.975).alias("high"), F.coalesce(F.size("l"), F.lit(0)).cast("bigint").alias("draws"))


def effective_sample_size(df: DataFrame, keys: list[str], order: str, value: str = "x", max_lag: int = 50) -> DataFrame:
    """keys, n, ess.  Lagged moments are aggregated in Catalyst; a group's 50 correlations decide the stop."""
    w = Window.partitionBy(*keys, "__part").orderBy(order)
    base = df.where(F.col(value).isNotNull()).select(*keys, order, F.col(value).cast("double").alias("v"))
    placed = ranked(base, [order], keys).withColumn("__i", F.col("rn") - 1)
    size = 1 << 16
    part = placed.withColumn("__part", F.explode(F.sequence(F.expr(f"__i div {size}"), F.expr(f"(__i + {max_lag}) div {size}")))).withColumn("__home", F.col("__part") == F.expr(f"__i div {size}"))
    part = part.withColumn("__lags", F.array(*[F.struct(F.lit(k).alias("k"), F.lag("v", k).over(w).alias("p")) for k in range(1, max_lag + 1)])).where("__home")
    pairs = part.select(*keys, "v", "n", F.explode("__lags").alias("e")).where("e.p is not null and e.k < n div 3")
    acf = pairs.groupBy(*keys, F.col("e.k").alias("k")).agg(F.coalesce(pearson(F.col("v"), F.col("e.p")), F.lit(0.0)).alias("r"))
    lists = acf.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("k", "r"))).alias("l"))
    whole = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.var_pop("v").alias("__var"))
    total = F.aggregate(
        F.coalesce(F.transform("l", lambda e: e["r"]), F.array().cast("array<double>")),
        F.struct(F.lit(0.0).alias("s"), F.lit(True).alias("on")),
        lambda a, r: F.struct((a["s"] + F.when(a["on"] & (r > 0), r).otherwise(F.lit(0.0))).alias("s"), (a["on"] & (r > 0)).alias("on")),
        lambda a: a["s"],
    )
    out = whole.join(lists, keys, "left").withColumn("__s", total)
    ess = F.when(F.col("n") < 3, F.col("n").cast("double")).when(F.col("__var") == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(1.0), F.least(F.col("n").cast("double"), F.col("n") / (1 + 2 * F.col("__s")))))
    return out.select(*keys, "n", ess.alias("ess"))


def least_squares_slope(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """keys, slope; NULL below three points."""
    return df.groupBy(*keys).agg(F.when(F.count(F.lit(1)) >= 3, F.regr_slope(y, x)).alias("slope"))


