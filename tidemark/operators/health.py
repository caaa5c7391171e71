"""Runtime health: rates between samples, slopes of a run's end, gate decisions, capacity and order guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.projections import KEYS

from .checks import with_previous


def scheduling_lag_ms(expected_ns: Column, actual_ns: Column) -> Column:
    """How late a heartbeat came; never below 0."""
    return F.greatest(F.lit(0.0), (actual_ns - expected_ns) / F.lit(1e6))


def sampled_clock(send_ms: Column, receive_ms: Column, server_ms: Column, send_ns: Column, receive_ns: Column, max_rtt_ms: float) -> dict[str, Column]:
    """offset_ms against the midpoint of a request, rtt_ms, and whether the sample is accepted."""
    rtt = F.greatest(F.lit(0.0), (receive_ns - send_ns) / F.lit(1e6))
    return {"offset_ms": server_ms - (send_ms + receive_ms) / F.lit(2.0), "rtt_ms": rtt, "accepted": rtt <= max_rtt_ms}


def rates(samples: DataFrame, counters: list[str], keys: list[str] = KEYS, ns: str = "monotonic_ns") -> DataFrame:
    """``samples`` with ``<counter>_rate``: the counter's growth since the sample before, by seconds; NULL at the first and where the clock hasn't advanced."""
    prev = with_previous(samples, [ns, *counters], keys)
    seconds = (F.col(ns) - F.col(f"prev_{ns}")) / F.lit(1e9)
    return prev.withColumns({f"{c}_rate": F.when(seconds > 0, (F.col(c) - F.col(f"prev_{c}")) / seconds) for c in counters}).drop(f"prev_{ns}", *[f"prev_{c}" for c in counters])


def late_slopes(samples: DataFrame, spans: dict[str, float], x: str, y: str, keys: list[str] = KEYS) -> DataFrame:
    """keys, last_x and ``slope_<name>``: the least-squares slope over each series' last ``spans`` of x; NULL below three samples."""
    ends = samples.groupBy(*keys).agg(F.max(x).alias("last_x"))
    rows = samples.join(ends, keys)
    inside = {n: F.col(x) >= F.col("last_x") - span for n, span in spans.items()}
    cut = lambda c, v: F.when(c, F.col(v))
    slopes = [F.when(F.count(cut(c, x)) >= 3, F.regr_slope(cut(c, y), cut(c, x))).alias(f"slope_{n}") for n, c in inside.items()]
    return rows.groupBy(*keys).agg(F.max("last_x").alias("last_x"), *slopes)


def decided(df: DataFrame, failures: dict[str, Column], warnings: dict[str, Column]) -> DataFrame:
    """``df`` with ``failure_reasons`` and ``warning_reasons`` (names of the conditions that hold, sorted) and ``decision``: FAIL with
    a failure, else WARNING with a warning, else PASS.  A condition that isn't known holds: no evidence is no pass."""
    names = lambda of: F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in of.items()]).cast("array<string>")))
    out = df.withColumns({"failure_reasons": names(failures), "warning_reasons": names(warnings)})
    return out.withColumn("decision", F.when(F.size("failure_reasons") > 0, "FAIL").when(F.size("warning_reasons") > 0, "WARNING").otherwise("PASS"))


def not_rising(df: DataFrame, keys: list[str] = KEYS, order: str = "capture_seq", value: str = "monotonic_ns") -> DataFrame:
    """keys, order, value and the one before it, where ``value`` doesn't strictly rise along ``order``."""
    return with_previous(df.select(*keys, order, value), [value], keys).where(F.col(value) <= F.col(f"prev_{value}"))


def over_capacity(df: DataFrame, limit: int, keys: list[str]) -> DataFrame:
    """keys and n of the groups with more than ``limit`` rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)


def best_levels(levels: DataFrame, book: list[str], depth: int, hard_limit: int = 100_000) -> DataFrame:
    """The best ``depth`` levels of each side; more than ``hard_limit`` of a side is an error."""
    order = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    side = Window.partitionBy(*book, "side")
    placed = levels.withColumns({"level": F.row_number().over(side.orderBy(order)), "__n": F.count(F.lit(1)).over(side)})
    checked = F.when(F.col("__n") <= hard_limit, F.col("level")).otherwise(F.raise_error(F.lit("more levels than the hard limit")).cast("int"))
    return placed.withColumn("level", checked).where(F.col("level") <= depth).drop("__n")
