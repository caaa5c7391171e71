"""Shared plumbing of the corpus operators: shared storage, Arrow maps, table reading."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none a temporary folder is used in local mode (tests); on a cluster
    that is an error, for executors would each write to a disk of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir isn't set, and {master} has no folder of its own that all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df``, written and read back; the write's own shuffle files go as soon as it has ended."""
    conf = df.sparkSession.conf
    before = conf.get(_DROP_SHUFFLES, "false")
    conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_DROP_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives lost executors."""
    return written(df, f"{shared_dir(df.sparkSession)}/tidemark/{name}-{uuid.uuid4().hex}")


class Scratch:
    """Intermediate tables of one computation, deleted from the shared folder as soon as others replace them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
        self.made = 0

    def table(self, df: DataFrame) -> DataFrame:
        """``df``, written and read back."""
        self.made += 1
        return written(df, f"{self.root}/{self.made - 1}")

    def drop(self, first: int, last: int) -> None:
        """Delete the tables number ``first`` to ``last`` (not included)."""
        jvm = self.spark._jvm
        for k in range(first, last):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{k}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def quoted(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns called ``names`` (any case): outputs replace inputs of the same name."""
    gone = {n.lower() for n in names}
    kept = [c for c in df.columns if c.lower() not in gone]
    return df if len(kept) == len(df.columns) else df.select(*[quoted(c) for c in kept])


def settled(verdict: Column) -> Column:
    """``verdict``, computed where it stands: a later filter on it isn't pushed below.

    Pushed down, a filter would carry copies of every expression the verdict rests on, inside
    lambda functions even once per element.
    """
    return F.when(F.monotonically_increasing_id() >= 0, verdict)


def schema_of(df: DataFrame, cols: list[str]) -> list[T.StructField]:
    return [df.schema[c] for c in cols]


def arrow_map(
    df: DataFrame,
    inputs: list[Column],
    keep: list[str],
    fields: list[T.StructField],
    fn: Callable[[Iterator[list[pa.Array]]], Iterator[tuple[slice, list[pa.Array]]]],
) -> DataFrame:
    """Append columns computed by Python from Arrow batches, without touching the kept columns.

    ``fn`` gets an iterator of input arrays (one list per Arrow batch) and yields, for every
    batch, ``(rows, arrays)``: the slice of the batch's rows and the output arrays for them.
    Several slices per batch keep the memory of one output batch bounded.  Kept columns are
    passed through as they are; their names can be anything.
    """
    n_in = len(inputs)
    sent = df.select(
        *[c.alias(f"__tm_in{i}") for i, c in enumerate(inputs)],
        *[quoted(c).alias(f"__tm_keep{i}") for i, c in enumerate(keep)],
    )
    out = T.StructType(
        [T.StructField(f"__tm_keep{i}", df.schema[c].dataType, True) for i, c in enumerate(keep)]
        + [T.StructField(f"__tm_out{i}", f.dataType, True) for i, f in enumerate(fields)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        pending: list[pa.RecordBatch] = []

        def feed() -> Iterator[list[pa.Array]]:
            for b in batches:
                if b.num_rows:
                    pending.append(b)
                    yield [b.column(i) for i in range(n_in)]

        for rows, arrays in fn(feed()):
            b = pending[-1]
            start, stop, _ = rows.indices(b.num_rows)
            kept = [b.column(i).slice(start, stop - start) for i in range(n_in, b.num_columns)]
            cols = [a if a.type == f.type else a.cast(f.type) for a, f in zip([*kept, *arrays], schema, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)
            del pending[:-1]

    made = sent.mapInArrow(run, out)
    return made.toDF(*keep, *[f.name for f in fields])


def slices(lengths, limit: int) -> Iterator[slice]:
    """Cut a batch into slices of whole rows with about ``limit`` units each (one row at least)."""
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > limit:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield slice(start, len(lengths))
