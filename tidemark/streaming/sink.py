"""A transactional file sink: each micro-batch is staged, read back, listed and made visible by one rename.

A batch is committed when its folder stands under ``batches``; folders there are the ledger.  A batch that comes again
after it was committed writes nothing; one that was cut off before leaves only a staged folder that no reader sees
and the next attempt removes.  The file system must rename folders atomically (as HDFS and local disks do).

Rows of a batch are dealt by partition and sorted by ``order`` in each file; ``rows_per_file`` bounds files by
rows, the query's trigger bounds how long rows wait.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.checks import IntegrityError

#: What a step's end is told as, in order.
STEPS = ("staged", "checked", "listed", "committed")


class Folder:
    """A folder of the session's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
        self.fs = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._at(f"{self.path}/{name}"))

    def names(self, name: str) -> list[str]:
        at = self._at(f"{self.path}/{name}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def remove(self, name: str) -> None:
        self.fs.delete(self._at(f"{self.path}/{name}"), True)

    def rename(self, old: str, new: str) -> bool:
        """False if ``new`` is there already."""
        target = self._at(f"{self.path}/{new}")
        self.fs.mkdirs(target.getParent())
        return not self.fs.exists(target) and self.fs.rename(self._at(f"{self.path}/{old}"), target)


def content(columns: list[str]) -> list[Column]:
    """Rows and the sum of their hashes: equal for equal contents in any order."""
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("hash")]


def listed(table: DataFrame, keys: list[str], order: str, time: str) -> DataFrame:
    """A manifest row for each file of a table: keys, path below ``batches``, size, rows, bounds of order and time, content."""
    rows = table.withColumns({"__path": F.col("_metadata.file_path"), "__size": F.col("_metadata.file_size")})
    bounds = [f(c).alias(n) for n, f, c in (("first_seq", F.min, order), ("last_seq", F.max, order), ("start_time", F.min, time), ("end_time", F.max, time), ("file_size", F.max, "__size"))]
    own = [c for c in table.columns]
    return rows.groupBy("__path", *keys).agg(*bounds, *content(own)).select(F.regexp_extract("__path", r"/data/(.*)$", 1).alias("file_path"), *keys, "file_size", *[c for c in ("rows", "hash", "first_seq", "last_seq", "start_time", "end_time")])


@dataclass
class TransactionalSink:
    """``root``: the sink's folder; ``keys``: partition columns.  ``told`` hears of each step (tests end a batch there)."""

    root: str
    keys: list[str]
    order: str = "capture_seq"
    time: str = "ts"
    rows_per_file: int = 200_000
    told: Callable[[str, int], None] = field(default=lambda step, batch_id: None)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Commit one micro-batch, once."""
        spark = batch.sparkSession
        folder = Folder(spark, self.root)
        if folder.exists(f"batches/{batch_id}"):
            return
        for name in folder.names("staging"):
            if name.split("-")[0] == str(batch_id):
                folder.remove(f"staging/{name}")
        stage = f"staging/{batch_id}-{uuid.uuid4().hex}"
        path = f"{self.root}/{stage}"
        batch = batch.persist()
        try:
            wanted = batch.agg(*content(batch.columns)).first()
            if not wanted["rows"]:
                return
            dealt = batch.repartition(*self.keys).sortWithinPartitions(*self.keys, self.order)
            dealt.write.option("maxRecordsPerFile", self.rows_per_file).partitionBy(*self.keys).parquet(f"{path}/data")
            self.told("staged", batch_id)
            made = spark.read.schema(batch.schema).parquet(f"{path}/data").select(*batch.columns)
            if made.agg(*content(batch.columns)).first() != wanted:
                raise IntegrityError(f"batch {batch_id} reads back otherwise than it was written")
            self.told("checked", batch_id)
        finally:
            batch.unpersist()
        listed(made, self.keys, self.order, self.time).withColumn("batch_id", F.lit(batch_id)).write.parquet(f"{path}/manifest")
        self.told("listed", batch_id)
        if not folder.rename(stage, f"batches/{batch_id}"):
            folder.remove(stage)
            return
        self.told("committed", batch_id)

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> DataStreamWriter:
        """Run ``stream`` into the sink; ``trigger`` as for `DataStreamWriter.trigger`."""
        return stream.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    def committed(self, spark: SparkSession) -> list[int]:
        return sorted(int(n) for n in Folder(spark, self.root).names("batches"))

    def read(self, spark: SparkSession, part: str = "data") -> DataFrame:
        """Committed rows (``data``) or their ``manifest``."""
        paths = [f"{self.root}/batches/{i}/{part}" for i in self.committed(spark)]
        frames = [spark.read.parquet(p) for p in paths]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out
