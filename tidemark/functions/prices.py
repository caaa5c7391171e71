"""Scalar formulas as column builders: prices, depth, costs, regimes, staleness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COST_BPS = 10_000


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def spread_bps(bid: Column, ask: Column) -> Column:
    """Spread in basis points of the mid; NULL at a zero mid."""
    m = mid(bid, ask).cast("double")
    return F.when(m != 0, (ask - bid).cast("double") / m * COST_BPS)


def microprice(bid: Column, bid_qty: Column, ask: Column, ask_qty: Column) -> Column:
    """Top-of-book price weighted by the opposite side's quantity; NULL without quantity."""
    total = (bid_qty + ask_qty).cast("double")
    return F.when(total > 0, (ask.cast("double") * bid_qty.cast("double") + bid.cast("double") * ask_qty.cast("double")) / total)


def depth_volume(levels: Column, n: int) -> Column:
    """Exact quantity of the best ``n`` levels of ``array<struct<price, quantity>>``."""
    zero = F.lit(0).cast("decimal(28,8)")
    return F.aggregate(F.slice(levels, 1, n), zero, lambda a, x: (a + x["quantity"]).cast("decimal(28,8)"))


def imbalance(bid: Column, ask: Column) -> Column:
    """(bid - ask) / (bid + ask) of two volumes; NULL without volume."""
    total = (bid + ask).cast("double")
    return F.when(total != 0, (bid - ask).cast("double") / total)


def aggressor_side(buyer_is_maker: Column) -> Column:
    return F.when(buyer_is_maker, "SELL").otherwise("BUY")


def latency_ms(local: Column, exchange: Column) -> Column:
    """Signed, never clamped."""
    return (F.unix_micros(local) - F.unix_micros(exchange)) / F.lit(1000.0)


def backpressure(queued: Column, capacity: Column) -> Column:
    ratio = queued / capacity
    return F.when(ratio >= 0.9, "CRITICAL").when(ratio >= 0.7, "WARNING").otherwise("NORMAL")


def backoff(initial: Column, most: Column, attempt: Column) -> Column:
    return F.least(most, initial * F.pow(F.lit(2.0), attempt - 1))


def invalid_reasons(**conditions: Column) -> Column:
    """Names of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))


def feed_is_stale(connected: Column, ages_ms: list[Column], limit_ms: float) -> Column:
    """Disconnected, or some age unknown or over the limit."""
    out = ~F.coalesce(connected, F.lit(False))
    for a in ages_ms:
        out = out | a.isNull() | (a > limit_ms)
    return out


def fingerprint(value: Column) -> Column:
    """SHA-256 of a value's JSON with sorted keys (structs are written in the order of their fields)."""
    return F.sha2(F.to_json(value), 256)
