"""Tumbling windows, the same for batch and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tumbling_counts(events: DataFrame, time: str = "ts", width: str = "1 hour", late: str | None = None) -> DataFrame:
    """symbol, window_start, rows, volume; with ``late`` a watermark bounds the state of a stream."""
    if late:
        events = events.withWatermark(time, late)
    out = events.groupBy("symbol", F.window(time, width).alias("w")).agg(F.count(F.lit(1)).alias("rows"), F.sum("qty").alias("volume"))
    return out.select("symbol", F.col("w.start").alias("window_start"), "rows", "volume")


def stream_of(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    """Files of a folder as a stream, a bounded number a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def drain(df: DataFrame, path: str, checkpoint: str, partitions: list[str] = (), mode: str = "append") -> None:
    """Run a stream to the end of what there is, into Parquet, exactly once."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (writer.partitionBy(*partitions) if partitions else writer).start().awaitTermination()
