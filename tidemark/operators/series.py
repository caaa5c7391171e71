"""Ordered series at any length: chunked windows, running counts and ranks without one task a series.

A window over a whole series puts the series in one task.  Frames of bounded reach don't need that:
a series is cut in chunks of its clock, rows near a border are copied to the neighbouring chunk they
matter to, windows run per chunk, and only rows at home in their chunk are kept.  Unbounded sums and
ranks go in two levels: inside chunks, and over the chunks' totals.

Spark walks a frame with two moving ends again for each row, so its cost is rows times rows in reach.  Frames here
start where the chunk does and move one end: a sum in reach is a difference of two running ones, and what was last
in reach is the last one at all, if its time is.  Questions ahead of a row ask the same of the clock run backwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.session import shared_table
from tidemark.sources.projections import KEYS

SECOND = 1_000_000_000
#: Nanoseconds of a chunk: long against the contexts, short enough that a dense series is many tasks.
CHUNK_NS = 60 * SECOND


def chunked(df: DataFrame, before_ns: int, after_ns: int, ns: str = "monotonic_ns", chunk_ns: int = CHUNK_NS) -> DataFrame:
    """``df`` with ``chunk`` and ``home``; rows up to ``before_ns`` before and ``after_ns`` after a chunk are copied to it."""
    t = F.col(ns)
    low = F.floor((t - F.lit(after_ns)) / F.lit(chunk_ns)).cast("long")
    high = F.floor((t + F.lit(before_ns)) / F.lit(chunk_ns)).cast("long")
    own = F.floor(t / F.lit(chunk_ns)).cast("long")
    return df.withColumn("chunk", F.explode(F.sequence(low, high))).withColumn("home", F.col("chunk") == own)


def chunk_window(keys: list[str] = KEYS, order: list[str] | str = "monotonic_ns"):
    order = [order] if isinstance(order, str) else order
    return Window.partitionBy(*keys, "chunk").orderBy(*order)


def backward_window(keys: list[str] = KEYS):
    """The chunks' window with the clock run backwards: its frame up to ``-h`` holds what is ``h`` or more later."""
    return Window.partitionBy(*keys, "chunk").orderBy(F.col("monotonic_ns").desc())


def upto(window: WindowSpec, end: int) -> WindowSpec:
    """``window`` from its start to ``end`` nanoseconds from the row, so that each row enters the frame once."""
    return window.rangeBetween(Window.unboundedPreceding, end)


def reach_sum(value: str, window: WindowSpec, size: int, exact: str) -> Column:
    """Sum of ``value`` from ``size`` before the row up to one nanosecond before it, NULL if the chunk has none before; ``exact``: an integer
    or decimal type that holds the chunk's sum."""
    total = lambda end: F.sum(value).over(upto(window, end)).cast(exact)
    return total(-1) - F.coalesce(total(-size - 1), F.lit(0).cast(exact))


def at_home(df: DataFrame) -> DataFrame:
    return df.where("home").drop("home", "chunk")


def running_sum(df: DataFrame, value: Column, out: str, keys: list[str] = KEYS, order: str = "capture_seq", size: int = 1 << 20) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to and including each, in ``order`` (an integer)."""
    cut = df.withColumns({"__part": F.floor(F.col(order) / F.lit(size)).cast("long"), "__value": value})
    totals = cut.groupBy(*keys, "__part").agg(F.sum("__value").alias("__total"))
    ahead = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__carry", F.coalesce(F.sum("__total").over(ahead), F.lit(0))).drop("__total")
    inside = Window.partitionBy(*keys, "__part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return cut.join(totals, [*keys, "__part"]).withColumn(out, F.sum("__value").over(inside) + F.col("__carry")).drop("__part", "__value", "__carry")


def last_before_each(df: DataFrame, values: dict[str, Column], keys: list[str] = KEYS, order: str = "capture_seq", size: int = 1 << 20) -> DataFrame:
    """``df`` with, for each name of ``values``, its last value that isn't null strictly before each row, in ``order`` (an
    integer, no ties within ``keys``)."""
    cut = df.withColumn("__part", F.floor(F.col(order) / F.lit(size)).cast("long")).withColumns({f"__v_{n}": v for n, v in values.items()})
    lasts = cut.groupBy(*keys, "__part").agg(*[F.max_by(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), F.col(order))).alias(f"__l_{n}") for n in values])
    ahead = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    lasts = lasts.select(*keys, "__part", *[F.last(f"__l_{n}", ignorenulls=True).over(ahead).alias(f"__c_{n}") for n in values])
    inside = Window.partitionBy(*keys, "__part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = {n: F.coalesce(F.last(f"__v_{n}", ignorenulls=True).over(inside), F.col(f"__c_{n}")) for n in values}
    return cut.join(lasts, [*keys, "__part"]).withColumns(own).drop("__part", *[f"__{x}_{n}" for n in values for x in "vc"])


def last_before(df: DataFrame, value: Column, out: str, keys: list[str] = KEYS, order: str = "capture_seq", size: int = 1 << 20) -> DataFrame:
    """``df`` with ``out``, the last ``value`` that isn't null strictly before each row."""
    return last_before_each(df, {out: value}, keys, order, size)


def _cut_by_value(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """``df`` dealt to ranges of ``by`` as a table with the range's number ``__part``; equal values share a range."""
    whole = shared_table(df, name)
    return shared_table(whole.repartitionByRange(*by).withColumn("__part", F.spark_partition_id()), name)


def _shifted(cut: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """(keys, __part, __shift, n): ``size`` summed over the ranges below and over all; a row per key and range."""
    below = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(*keys, "__part").agg(size.alias("__n"))
    return sizes.select(*keys, "__part", F.coalesce(F.sum("__n").over(below), F.lit(0)).alias("__shift"), F.sum("__n").over(Window.partitionBy(*keys)).alias("n"))


def ranked(df: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """``df`` with ``rn`` (1-based place in ``by`` order within ``keys``) and ``n``.

    Rows are dealt to value ranges, whose number follows the data; places are counted inside a range
    and shifted by the sizes of the ranges below.
    """
    cut = _cut_by_value(df, [*keys, *by], "ranked")
    inside = Window.partitionBy(*keys, "__part").orderBy(*by)
    out = cut.join(_shifted(cut, keys, F.count(F.lit(1))), [*keys, "__part"])
    return out.withColumn("rn", F.row_number().over(inside) + F.col("__shift")).drop("__part", "__shift")


def average_ranks(df: DataFrame, value: str, keys: list[str], rank: str) -> DataFrame:
    """(keys, value, ``rank``): the average place of each distinct value, so that a frequent one is a single row."""
    values = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__m"))
    cut = _cut_by_value(values, [*keys, value], "ranks")
    inside = Window.partitionBy(*keys, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = cut.join(_shifted(cut, keys, F.sum("__m")), [*keys, "__part"])
    return out.select(*keys, value, (F.coalesce(F.sum("__m").over(inside), F.lit(0)) + F.col("__shift") + (F.col("__m") + 1) / F.lit(2.0)).alias(rank))
