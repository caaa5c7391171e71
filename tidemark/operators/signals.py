"""Signal rules as columns, and the one-position shadow simulator with explicit costs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_table
from tidemark.sources.projections import KEYS

from .series import last_before_each
from .spacing import non_overlapping as non_overlapping


@dataclass(frozen=True)
class Rule:
    """All features must reach their thresholds on one side; ``score``: the rule's strength."""

    name: str
    thresholds: dict[str, float]
    score: str  # "first": size of the first feature; "least": smallest multiple of a threshold


RULES = (
    Rule("microprice_momentum", {"microprice_offset_bps": 0.05, "imbalance_l1": 0.2}, "first"),
    Rule("book_imbalance", {"imbalance_l5": 0.6}, "first"),
    Rule("trade_flow", {"trade_imbalance_1s": 0.6}, "first"),
    Rule("combined_baseline", {"microprice_offset_bps": 0.03, "imbalance_l5": 0.4, "trade_imbalance_1s": 0.4}, "least"),
)


def signal(rule: Rule, valid: str = "feature_valid") -> Column:
    """struct(side, score, evidence), NULL where the rule doesn't fire or a feature is missing."""
    cols = {n: F.col(n).cast("double") for n in rule.thresholds}
    up = down = F.col(valid)
    for n, t in rule.thresholds.items():
        up, down = up & (cols[n] >= t), down & (cols[n] <= -t)
    ratios = [F.abs(cols[n]) / F.lit(t) for n, t in rule.thresholds.items()]
    score = F.abs(next(iter(cols.values()))) if rule.score == "first" else (F.least(*ratios) if len(ratios) > 1 else ratios[0])
    evidence = F.array(*[F.struct(F.lit(n).alias("name"), c.alias("value")) for n, c in cols.items()])
    side = F.when(up, "LONG").when(down, "SHORT")
    return F.when(up | down, F.struct(side.alias("side"), score.alias("score"), evidence.alias("evidence")))


def all_signals(features: DataFrame, rules: tuple[Rule, ...] = RULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per rule that fires: keys, capture_seq, monotonic_ns, ``carry``, strategy, side, score, evidence."""
    fired = F.array_compact(F.array(*[F.when(signal(r).isNotNull(), F.struct(F.lit(r.name).alias("strategy"), signal(r).alias("s"))) for r in rules]))
    own = [*KEYS, "capture_seq", "monotonic_ns", *carry]
    out = features.select(*own, F.explode(fired).alias("e"))
    return out.select(*own, F.col("e.strategy").alias("strategy"), F.col("e.s.side").alias("side"), F.col("e.s.score").alias("score"), F.col("e.s.evidence").alias("evidence"))


def shadow_positions(features: DataFrame, rule: Rule, holding_ns: int, mid: str = "mid_price", spread: str = "spread_bps", force_close: bool = False) -> DataFrame:
    """One position at a time: enter on a signal when flat, leave at the first row ``holding_ns`` or more later;
    a new entry on the exit row is allowed.  The path covers entry and exit.

    No row lies between the due time and the exit, so entries are the signals spaced greedily by ``holding_ns`` (`spacing`), and a row's
    position is the one of the last entry before it.  No series or stretch of one is a group.
    """
    rows = features.select(*KEYS, "capture_seq", "monotonic_ns", F.col(mid).cast("double").alias("mid"), F.col(spread).cast("double").alias("spread"), signal(rule)["side"].alias("side"))
    rows = shared_table(rows, "shadow-rows")
    entries = non_overlapping(rows.where("side is not null").select(*KEYS, "capture_seq", "monotonic_ns"), holding_ns).select(*KEYS, "capture_seq", F.lit(True).alias("enters"))
    own = F.when(F.col("enters"), F.struct("capture_seq", "monotonic_ns", "mid", "spread", "side"))
    marked = last_before_each(rows.join(entries, [*KEYS, "capture_seq"], "left"), {"before": own})
    # an entry begins its own position, and may end the one before
    at = marked.select(*KEYS, "capture_seq", "monotonic_ns", "mid", "spread", F.explode(F.array_compact(F.array("before", own))).alias("e"))
    after = F.col("capture_seq") > F.col("e.capture_seq")
    due = after & (F.col("monotonic_ns") >= F.col("e.monotonic_ns") + holding_ns)
    row = F.struct("capture_seq", "monotonic_ns", "mid", "spread")
    held = at.groupBy(*KEYS, "e").agg(F.min(F.when(due, row)).alias("x"), F.max(row).alias("last"), F.max(F.when(~due, F.col("mid"))).alias("hi"), F.min(F.when(~due, F.col("mid"))).alias("lo"))
    reason = F.when(F.col("x").isNotNull(), "TIME_STOP").otherwise("END_OF_DATA")
    closed = held.withColumns({"exit_reason": reason, "x": F.coalesce("x", "last")}).where(F.lit(force_close) | (F.col("exit_reason") == "TIME_STOP"))
    return closed.select(
        *KEYS, F.lit(rule.name).alias("strategy"), "e.side", F.col("e.monotonic_ns").alias("entry_ns"), F.col("x.monotonic_ns").alias("exit_ns"), F.col("e.mid").alias("entry_mid"), F.col("x.mid").alias("exit_mid"),
        F.col("e.spread").alias("entry_spread_bps"), F.col("x.spread").alias("exit_spread_bps"), F.greatest("hi", "x.mid").alias("path_max"), F.least("lo", "x.mid").alias("path_min"), "exit_reason",
    )


@dataclass(frozen=True)
class Costs:
    """Fees and slippage in basis points; whether the spread is crossed and the entry is a maker order."""

    maker_fee_bps: float = 0.0
    taker_fee_bps: float = 0.0
    entry_slippage_bps: float = 0.0
    exit_slippage_bps: float = 0.0
    maker_entry: bool = False
    cross_spread: bool = True

    def __post_init__(self):
        if min(self.maker_fee_bps, self.taker_fee_bps, self.entry_slippage_bps, self.exit_slippage_bps) < 0:
            raise ValueError("fees and slippage cannot be negative")

    @property
    def round_trip_bps(self) -> float:
        return (self.maker_fee_bps if self.maker_entry else self.taker_fee_bps) + self.taker_fee_bps + self.entry_slippage_bps + self.exit_slippage_bps


def priced(trades: DataFrame, costs: Costs, notional: float = 1000.0) -> DataFrame:
    """``trades`` with executable prices, gross, slippage, fees, net, edges, holding time and excursions."""
    sign = F.when(F.col("side") == "LONG", 1.0).otherwise(-1.0)
    half = lambda c: F.col(c) / 2 if costs.cross_spread else F.lit(0.0)
    entry_bps = F.lit(costs.entry_slippage_bps) + (F.lit(0.0) if costs.maker_entry else half("entry_spread_bps"))
    exit_bps = F.lit(costs.exit_slippage_bps) + half("exit_spread_bps")
    entry_fee = costs.maker_fee_bps if costs.maker_entry else costs.taker_fee_bps
    out = trades.withColumns(
        {
            "quantity": F.lit(notional) / F.col("entry_mid"),
            "entry_price": F.col("entry_mid") * (1 + sign * entry_bps / 10000),
            "exit_price": F.col("exit_mid") * (1 - sign * exit_bps / 10000),
        }
    )
    out = out.withColumns({"gross_pnl": sign * F.col("quantity") * (F.col("exit_mid") - F.col("entry_mid")), "__before_fees": sign * F.col("quantity") * (F.col("exit_price") - F.col("entry_price"))})
    out = out.withColumns(
        {
            "slippage_cost": F.col("gross_pnl") - F.col("__before_fees"),
            "fees": F.col("quantity") * (F.col("entry_price") * entry_fee + F.col("exit_price") * costs.taker_fee_bps) / 10000,
        }
    )
    out = out.withColumn("net_pnl", F.col("__before_fees") - F.col("fees")).drop("__before_fees")
    up, down = F.log(F.col("path_max") / F.col("entry_mid")) * 10000, F.log(F.col("path_min") / F.col("entry_mid")) * 10000
    return out.withColumns(
        {
            "gross_edge_bps": F.col("gross_pnl") / notional * 10000,
            "net_edge_bps": F.col("net_pnl") / notional * 10000,
            "holding_time_ms": (F.col("exit_ns") - F.col("entry_ns")) / F.lit(1e6),
            "mfe_bps": F.when(F.col("side") == "LONG", up).otherwise(-down),
            "mae_bps": F.when(F.col("side") == "LONG", down).otherwise(-up),
            "turnover": F.lit(2 * notional),
        }
    )


def strategy_metrics(trades: DataFrame, keys: list[str]) -> DataFrame:
    """Sums, rates, drawdown from a peak of at least 0, longest run of losses, ...; NULL where undefined.

    Trades are few against observations: the running columns go by trade order within ``keys``.
    """
    w = Window.partitionBy(*keys).orderBy("entry_ns")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    run = trades.withColumn("__cum", F.sum("net_pnl").over(upto))
    run = run.withColumns({"__peak": F.greatest(F.lit(0.0), F.max("__cum").over(upto)), "__island": F.sum((F.col("net_pnl") >= 0).cast("int")).over(upto)})
    streaks = run.groupBy(*keys, "__island").agg(F.sum((F.col("net_pnl") < 0).cast("long")).alias("losses")).groupBy(*keys).agg(F.max("losses").alias("maximum_consecutive_losses"))
    net, win, loss = F.col("net_pnl"), F.col("net_pnl") > 0, F.col("net_pnl") < 0
    lost = F.sum(F.when(loss, net))
    base = run.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum((F.col("side") == "LONG").cast("long")).alias("long_count"),
        F.sum((F.col("side") == "SHORT").cast("long")).alias("short_count"),
        F.sum("gross_pnl").alias("gross_pnl"),
        F.sum("fees").alias("fees"),
        F.sum("slippage_cost").alias("slippage_cost"),
        F.sum("net_pnl").alias("net_pnl"),
        F.avg("net_pnl").alias("average_net_pnl"),
        F.percentile("net_pnl", 0.5).alias("median_net_pnl"),
        F.avg(win.cast("double")).alias("win_rate"),
        F.avg(F.when(win, net)).alias("average_win"),
        F.avg(F.when(loss, net)).alias("average_loss"),
        F.when(lost.isNull(), F.when(F.max(win), F.lit(float("inf")))).otherwise(F.coalesce(F.sum(F.when(win, net)), F.lit(0.0)) / F.abs(lost)).alias("profit_factor"),
        F.max(F.col("__peak") - F.col("__cum")).alias("maximum_drawdown"),
        F.avg("holding_time_ms").alias("average_holding_time_ms"),
        F.avg("mfe_bps").alias("average_mfe_bps"),
        F.avg("mae_bps").alias("average_mae_bps"),
        F.sum("turnover").alias("turnover"),
        F.when(F.sum("gross_pnl") > 0, (F.sum("fees") + F.sum("slippage_cost")) / F.sum("gross_pnl") * 100).alias("cost_percent_of_gross"),
        F.avg("gross_edge_bps").alias("break_even_round_trip_cost_bps"),
    )
    return base.join(streaks, keys)
