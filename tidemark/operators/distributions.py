"""Cumulative distributions with a bounded recent part, reported at checkpoints of a series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_table
from tidemark.sources.projections import KEYS

from .series import running_sum

#: Values that quantiles look back on.
CAPACITY = 6000


def cumulative(df: DataFrame, value: str, keys: list[str] = KEYS, every: int = 1000, capacity: int = CAPACITY) -> DataFrame:
    """keys, checkpoint, last_seq, count, retained, mean, maximum, p50, p95, p99 after each ``every`` values of a series, and at its end.

    Count, mean and maximum are of all finite values so far, quantiles of the last ``capacity`` of them (the median, and the
    values at the places int(0.95 (n - 1)) and int(0.99 (n - 1))).  Null and non-finite values don't count.

    Chunks of ``every`` values have sums of their own that are added up over the chunks; a value is copied to the
    checkpoints that still remember it, capacity / every + 1 at most, so every checkpoint is a task's work of bounded size.
    """
    v = F.col(value).cast("double")
    finite = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))).select(*keys, "capture_seq", v.alias("v"))
    placed = running_sum(finite, F.lit(1), "place", keys)
    placed = shared_table(placed.withColumn("checkpoint", F.expr(f"(place - 1) div {every}")), "distribution")
    chunks = placed.groupBy(*keys, "checkpoint").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.max("v").alias("m"), F.max("capture_seq").alias("last_seq"))
    so_far = Window.partitionBy(*keys).orderBy("checkpoint").rowsBetween(Window.unboundedPreceding, 0)
    totals = chunks.select(*keys, "checkpoint", "last_seq", F.sum("n").over(so_far).alias("count"), (F.sum("s").over(so_far) / F.sum("n").over(so_far)).alias("mean"), F.max("m").over(so_far).alias("maximum"))
    # the last checkpoint whose latest ``capacity`` values can hold the value
    until = F.expr(f"(place + {capacity} - 2) div {every}")
    seen = placed.select(*keys, "place", "v", F.explode(F.sequence(F.col("checkpoint"), until)).alias("checkpoint"))
    recent = seen.join(totals.select(*keys, "checkpoint", "count"), [*keys, "checkpoint"]).where(F.col("place") > F.col("count") - capacity)
    lists = recent.groupBy(*keys, "checkpoint").agg(F.sort_array(F.collect_list("v")).alias("l"))
    at = lambda i: F.get("l", i.cast("int"))
    n = F.size("l")
    middle = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2
    quantiles = {"retained": n.cast("bigint"), "p50": middle, "p95": at(F.floor((n - 1) * 0.95)), "p99": at(F.floor((n - 1) * 0.99))}
    return totals.join(lists, [*keys, "checkpoint"]).select(*keys, "checkpoint", "last_seq", "count", "mean", "maximum", *[c.alias(k) for k, c in quantiles.items()])
