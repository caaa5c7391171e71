"""Clock offsets carried to events, latency reports, wall-clock steps, hour fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.projections import KEYS

from .checks import with_previous
from .series import at_home, chunk_window, chunked, running_sum


def rolling_clock(samples: DataFrame, count: int = 5, keys: list[str] = KEYS) -> DataFrame:
    """Accepted samples with the status of the last ``count`` of them: medians, deviation, least round trip, drift.

    Samples come about once a second, so they are few against events.
    """
    w = Window.partitionBy(*keys).orderBy("capture_seq").rowsBetween(1 - count, 0)
    out = samples.where("accepted").withColumn("__o", F.collect_list("offset_ms").over(w))
    out = out.withColumns(
        {
            "clock_offset_ms": F.percentile("offset_ms", 0.5).over(w),
            "clock_rtt_ms": F.percentile("rtt_ms", 0.5).over(w),
            "clock_min_rtt_ms": F.min("rtt_ms").over(w),
            "clock_samples": F.count(F.lit(1)).over(w),
            "clock_drift_ms": F.col("offset_ms") - F.first("offset_ms").over(w),
        }
    )
    away = F.array_sort(F.transform("__o", lambda x: F.abs(x - F.col("clock_offset_ms"))))
    half = F.size(away) / F.lit(2)
    mad = (F.get(away, F.floor((F.size(away) - 1) / F.lit(2)).cast("int")) + F.get(away, F.floor(half).cast("int"))) / F.lit(2.0)
    return out.withColumn("clock_mad_ms", mad).drop("__o")


def latest_before(events: DataFrame, states: DataFrame, columns: list[str], keys: list[str] = KEYS, size: int = 1 << 20) -> DataFrame:
    """``events`` with the columns of the last state captured before each, in two levels like a running sum."""
    marked = states.select(*keys, "capture_seq", F.struct(*columns).alias("__s"))
    asked = events.withColumn("__event", F.lit(True))
    both = asked.unionByName(marked, allowMissingColumns=True).withColumn("__c", F.floor(F.col("capture_seq") / F.lit(size)).cast("long"))
    ends = both.groupBy(*keys, "__c").agg(F.max_by("__s", F.when(F.col("__s").isNotNull(), F.col("capture_seq"))).alias("__end"))
    before = Window.partitionBy(*keys).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("__carry", F.last("__end", ignorenulls=True).over(before)).drop("__end")
    inside = Window.partitionBy(*keys, "__c").orderBy("capture_seq").rowsBetween(Window.unboundedPreceding, 0)
    out = both.join(ends, [*keys, "__c"]).withColumn("__l", F.coalesce(F.last("__s", ignorenulls=True).over(inside), F.col("__carry")))
    return out.where("__event").select(*events.columns, *[F.col("__l")[c].alias(c) for c in columns])


def interval_latest(left: DataFrame, right: DataFrame, reach_ms: Column, most_ms: int, value: str, keys: list[str] = KEYS) -> DataFrame:
    """``left`` with ``value`` of the last right row at 0 to ``reach_ms`` (a column of right, at most ``most_ms``) after it.

    Both sides are cut in slices of ``most_ms``; a left row meets the right rows of its own and the next slice.
    """
    step = most_ms * 1_000_000
    ids = [*keys, "capture_seq"]
    a = left.select(*ids, "monotonic_ns", F.explode(F.array(F.expr(f"monotonic_ns div {step}"), F.expr(f"monotonic_ns div {step} + 1"))).alias("slice"))
    b = right.select(*keys, F.expr(f"monotonic_ns div {step}").alias("slice"), F.col("monotonic_ns").alias("r_ns"), F.col("capture_seq").alias("r_seq"), F.col(value).alias("r_value"), reach_ms.alias("reach"))
    near = a.join(b, [*keys, "slice"]).where((F.col("r_ns") >= F.col("monotonic_ns")) & ((F.col("r_ns") - F.col("monotonic_ns")) / 1e6 <= F.col("reach")))
    last = near.groupBy(*ids).agg(F.max_by("r_value", "r_seq").alias(f"nearby_{value}"))
    return left.join(last, ids, "left")


def hour_fragments(df: DataFrame, time: str = "ts", keys: list[str] = KEYS) -> DataFrame:
    """``df`` with ``hour`` and ``fragment``: stretches of one civil hour in capture order; an hour may come again."""
    hours = with_previous(df.withColumn("hour", F.date_trunc("hour", F.col(time))), ["hour"], keys)
    fresh = (~F.col("hour").eqNullSafe(F.col("prev_hour"))).cast("long")
    return running_sum(hours, fresh, "fragment", keys).drop("prev_hour")


def wall_clock_steps(df: DataFrame, time: str = "ts", keys: list[str] = KEYS) -> DataFrame:
    """keys, count of backward steps of the wall clock, the largest (ms) and the last one's capture_seq."""
    prev = with_previous(df.select(*keys, "capture_seq", F.unix_micros(F.col(time)).alias("us")), ["us"], keys)
    step = (F.col("prev_us") - F.col("us")) / F.lit(1000.0)
    return prev.groupBy(*keys).agg(
        F.sum(F.coalesce((step > 0).cast("long"), F.lit(0))).alias("backward_steps"), F.max(F.when(step > 0, step)).alias("largest_ms"), F.max(F.when(step > 0, F.col("capture_seq"))).alias("last_seq")
    )


def emit_on_change(df: DataFrame, columns: list[str], keys: list[str] = KEYS) -> DataFrame:
    """Rows whose columns differ from the row before."""
    prev = with_previous(df, columns, keys)
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"prev_{c}"))
    return prev.where(~same).drop(*[f"prev_{c}" for c in columns])


def intervals(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """``df`` with ``interval_ms`` since the row before, however long ago; NULL for the first."""
    cut = chunked(df, 0, 0)
    ends = cut.groupBy(*keys, "chunk").agg(F.max("monotonic_ns").alias("__end"))
    ends = ends.withColumn("__before", F.lag("__end").over(Window.partitionBy(*keys).orderBy("chunk"))).drop("__end")
    before = F.coalesce(F.lag("monotonic_ns").over(chunk_window(keys, ["monotonic_ns", "capture_seq"])), F.col("__before"))
    return at_home(cut.join(ends, [*keys, "chunk"]).withColumn("interval_ms", (F.col("monotonic_ns") - before) / 1e6).drop("__before"))


def recent_summary(df: DataFrame, value: str, keys: list[str], recent: int = 6000) -> DataFrame:
    """keys, count, mean and max of all values, and low-rank p50, p95, p99 of the last ``recent`` ones."""
    whole = df.groupBy(*keys).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    w = Window.partitionBy(*keys).orderBy(F.col("capture_seq").desc())
    last = df.where(F.col(value).isNotNull()).withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= recent)
    arrays = last.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("__v"))
    at = lambda q: F.get("__v", F.floor((F.size("__v") - 1) * F.lit(q)).cast("int"))
    return whole.join(arrays.select(*keys, at(0.5).alias("p50"), at(0.95).alias("p95"), at(0.99).alias("p99")), keys, "left")
