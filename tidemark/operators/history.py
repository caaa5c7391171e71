"""Point-in-time features: backward returns, realised volatility, trade flow.

A row sees what was captured up to its own place.  Of several observations of one instant the last one
captured stands for it, so an earlier instant counts with its last price; at the row's own instant the
row itself is the last.  Epochs (stretches between resynchronisations) are keys like others, and
nothing is carried from one to the next.  Frames are bounded, so long series are cut in chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.sources.projections import KEYS

from .series import SECOND, at_home, backward_window, chunk_window, chunked, reach_sum, running_sum, upto

RETENTION_NS = 15 * SECOND
RETURN_HORIZONS = {"250ms": SECOND // 4, "1s": SECOND, "5s": 5 * SECOND, "10s": 10 * SECOND}
WINDOWS = {"1s": SECOND, "5s": 5 * SECOND, "10s": 10 * SECOND}


def with_epochs(df: DataFrame, marks: DataFrame, keys: list[str] = KEYS, out: str = "epoch") -> DataFrame:
    """``df`` with the number of ``marks`` (keys, capture_seq) captured before each row."""
    both = df.withColumn("__mark", F.lit(0)).unionByName(marks.select(*keys, "capture_seq").withColumn("__mark", F.lit(1)), allowMissingColumns=True)
    return running_sum(both, F.col("__mark"), out, keys).where("__mark = 0").drop("__mark")


def _instants(df: DataFrame, before_ns: int, price: str, keys: list[str]) -> tuple[DataFrame, WindowSpec]:
    """``df`` in chunks with ``__last``, the price of the rows that are their instant's last, and the chunks' window in capture order."""
    order = chunk_window(keys, ["monotonic_ns", "capture_seq"])
    out = chunked(df, before_ns, 0).withColumn("__next", F.lead("monotonic_ns").over(order))
    last = F.when(~F.col("__next").eqNullSafe(F.col("monotonic_ns")), F.col(price).cast("double"))
    return out.withColumn("__last", last).drop("__next"), order


def seen(value: str) -> Column:
    """struct(ns, v) of the rows that have ``value``."""
    return F.when(F.col(value).isNotNull(), F.struct(F.col("monotonic_ns").alias("ns"), F.col(value).alias("v")))


def reach_squares(size: int, keys: list[str]) -> Column:
    """Of a table in chunks with ``__own``, the squares of the rows that stand for an instant (`seen`): those of the window before the
    row, summed without the first instant's; NULL if the window has none."""
    first = F.last("__own", ignorenulls=True).over(upto(backward_window(keys), size))
    return F.when(first["ns"] < F.col("monotonic_ns"), reach_sum("__own.v", chunk_window(keys), size, "decimal(36,28)") - first["v"])


def backward_returns(df: DataFrame, horizons: dict[str, int] = RETURN_HORIZONS, price: str = "price", keys: list[str] = KEYS) -> DataFrame:
    """``df`` with ``return_<h>``: ln of the price over the latest price at or before ``h`` ago, kept for 15 s."""
    out, _ = _instants(df, RETENTION_NS, price, keys)
    w = chunk_window(keys)
    out = out.withColumn("__seen", seen("__last"))
    cols = {}
    for name, h in horizons.items():
        old = F.last("__seen", ignorenulls=True).over(upto(w, -h))
        cols[f"return_{name}"] = F.when(old["ns"] >= F.col("monotonic_ns") - RETENTION_NS, F.log(F.col(price).cast("double") / old["v"]))
    return at_home(out.withColumns(cols).drop("__last", "__seen"))


def realized_volatility(df: DataFrame, windows: dict[str, int] = WINDOWS, price: str = "price", keys: list[str] = KEYS) -> DataFrame:
    """``df`` with ``realized_volatility_<w>``: root of the summed squared log returns inside the window; NULL below two instants.

    A window's sum is that of its instants' squares without the first one's, whose return began before the
    window; exact decimals keep the difference free of rounding.
    """
    out, order = _instants(df, 2 * max(windows.values()), price, keys)
    out = out.withColumn("__prev", F.last("__last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    square = F.coalesce(F.pow(F.log(F.col(price).cast("double") / F.col("__prev")), F.lit(2.0)), F.lit(0.0)).cast("decimal(32,28)")
    out = out.withColumn("__square", square).withColumn("__own", F.when(F.col("__last").isNotNull(), seen("__square")))
    cols = {f"realized_volatility_{name}": F.sqrt((reach_squares(size, keys) + F.col("__square")).cast("double")) for name, size in windows.items()}
    return at_home(out.withColumns(cols).drop("__last", "__prev", "__square", "__own"))


def flow_ratios(name: str) -> dict[str, Column]:
    """Signed and total volume, imbalance, buy ratio and average price of a window; NULL where undefined."""
    buy, sell = F.col(f"buy_{name}"), F.col(f"sell_{name}")
    total = buy + sell
    share = lambda x: F.when(total > 0, x.cast("double") / total.cast("double"))
    return {
        f"signed_{name}": (buy - sell).cast("decimal(28,8)"),
        f"total_{name}": total.cast("decimal(28,8)"),
        f"imbalance_{name}": share(buy - sell),
        f"buy_ratio_{name}": share(buy),
        f"vwap_{name}": share(F.col(f"notional_{name}")),
    }


def trade_flow(ticks: DataFrame, trades: DataFrame, windows: dict[str, int] = WINDOWS, price: str = "price", qty: str = "qty", side: str = "aggressor_side", keys: list[str] = KEYS) -> DataFrame:
    """``ticks`` with buy, sell, notional and count of the trades in each closed window that ends at the tick.

    Sums are exact decimals.  A frame up to one nanosecond before the tick is joined with the trades of
    the tick's own instant that were captured before it.
    """
    zero = F.lit(0).cast("decimal(28,8)")
    parts = {
        "buy": F.when(F.col(side) == "BUY", F.col(qty).cast("decimal(28,8)")).otherwise(zero),
        "sell": F.when(F.col(side) == "SELL", F.col(qty).cast("decimal(28,8)")).otherwise(zero),
        "notional": (F.col(price) * F.col(qty)).cast("decimal(37,16)"),
        "count": F.lit(1).cast("long"),
    }
    marked = trades.select(*keys, "monotonic_ns", "capture_seq", F.lit(False).alias("__tick"), *[v.alias(f"__{n}") for n, v in parts.items()], *[F.lit(None).cast(ticks.schema[c].dataType).alias(f"__c_{c}") for c in ticks.columns])
    asked = ticks.select(*keys, "monotonic_ns", "capture_seq", F.lit(True).alias("__tick"), *[F.lit(None).cast(marked.schema[f"__{n}"].dataType).alias(f"__{n}") for n in parts], *[F.col(c).alias(f"__c_{c}") for c in ticks.columns])
    both = chunked(marked.unionByName(asked), max(windows.values()), 0)
    past = chunk_window(keys)
    instant = Window.partitionBy(*keys, "chunk", "monotonic_ns").orderBy("capture_seq").rowsBetween(Window.unboundedPreceding, 0)
    sums = {"buy": "decimal(36,8)", "sell": "decimal(36,8)", "notional": "decimal(36,16)", "count": "bigint"}
    cols = {}
    for p, exact in sums.items():
        nil = F.lit(0).cast(exact)
        now = F.coalesce(F.sum(f"__{p}").over(instant).cast(exact), nil)
        for name, size in windows.items():
            cols[f"{p}_{name}"] = F.coalesce(reach_sum(f"__{p}", past, size, exact), nil) + now
    out = both.withColumns(cols).where("home and __tick")
    typed = {"buy": "decimal(28,8)", "sell": "decimal(28,8)", "notional": "decimal(37,16)", "count": "bigint"}
    made = out.select(*[F.col(f"__c_{c}").alias(c) for c in ticks.columns], *[F.col(f"{p}_{n}").cast(typed[p]).alias(f"{p}_{n}") for n in windows for p in parts])
    for name in windows:
        made = made.withColumns(flow_ratios(name))
    return made


def emission_grid(df: DataFrame, step_ns: int, anchor_ns: Column, keys: list[str] = KEYS) -> DataFrame:
    """The first row of each slot of an anchored grid; missed slots are skipped."""
    slot = F.floor((F.col("monotonic_ns") - anchor_ns) / F.lit(step_ns)).cast("long")
    return df.withColumn("slot", slot).groupBy(*keys, "slot").agg(F.min_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct("monotonic_ns", "capture_seq")).alias("r")).select(*keys, "slot", "r.*")
