"""Session defaults of the event engine."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times, adaptive execution and Arrow transfer; ``conf`` adds settings."""
    builder = SparkSession.builder.appName("tidemark")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in {**defaults, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's ``spark.checkpoint.dir``; only local mode (tests) may leave it unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def own_folder(spark: SparkSession) -> str:
    """Where this application's shared tables stand."""
    return f"{shared_folder(spark)}/tidemark-events/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete all shared tables of this application: for when results made of them have been read or written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read back: what follows doesn't compute it again.  It stays until `release`."""
    path = f"{own_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
