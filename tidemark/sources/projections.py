"""Event views over the driver tables: one ordered observation stream and its kinds.

One hour of wall time is one second of the monotonic clock, so horizons of milliseconds to seconds
can be used as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["capture_session_id", "symbol"]


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """capture_session_id, symbol, capture_seq, monotonic_ns, event_type, k, qty, price, ts."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value", "props")
    return raw.select(
        F.lit("S0").alias("capture_session_id"),
        F.concat(F.lit("SYM"), (F.col("user_id") % 4).cast("string")).alias("symbol"),
        F.col("event_id").alias("capture_seq"),
        F.expr("((unix_micros(cast(ts AS timestamp)) - 1704067200000000L) * 1000L) div 3600").alias("monotonic_ns"),
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("value").cast("decimal(18,8)").alias("qty"),
        F.expr("cast(cast(100 AS decimal(18,8)) + cast(value AS decimal(18,8)) AS decimal(18,8))").alias("price"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def trades(obs: DataFrame) -> DataFrame:
    """Clicks buy, views sell."""
    return obs.where(F.col("event_type").isin("click", "view")).withColumn("aggressor_side", F.when(F.col("event_type") == "click", "BUY").otherwise("SELL"))


def boundaries(obs: DataFrame) -> DataFrame:
    """Integrity boundaries."""
    return obs.where((F.col("event_type") == "error") & (F.col("k") < 10))


def mids(obs: DataFrame) -> DataFrame:
    """Mid observations with a validity flag and a signal in [-1, 1]."""
    return obs.where("event_type <> 'error'").select(
        *KEYS, "capture_seq", "monotonic_ns", "price", "qty", "k", "ts", (F.col("k") != 99).alias("feature_valid"), ((F.col("k") - F.lit(49.5)) / F.lit(49.5)).alias("x")
    )


def clock_samples(obs: DataFrame) -> DataFrame:
    """Exchange clock samples: offset, round trip, whether accepted."""
    return obs.where((F.col("event_type") == "error") & (F.col("k") >= 10)).select(
        *KEYS, "capture_seq", "monotonic_ns", (F.col("k") - 50).cast("double").alias("offset_ms"), F.col("qty").cast("double").alias("rtt_ms"), (F.col("qty") <= 200).alias("accepted")
    )


def book_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price levels: one book per order, odd lines bid, even lines ask; ``rank`` 1 is best."""
    raw = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return raw.select(
        F.col("l_orderkey").alias("book_id"),
        F.when(F.col("l_linenumber") % 2 == 1, "bid").otherwise("ask").alias("side"),
        F.expr("cast(l_extendedprice / l_quantity AS decimal(18,8))").alias("price"),
        F.col("l_quantity").cast("decimal(18,8)").alias("quantity"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )
