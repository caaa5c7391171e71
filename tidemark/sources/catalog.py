"""The dataset catalog: one manifest per file, selection of sessions, freezing, compaction, recovery.

Manifests are few (a row per file).  Contents are read and checked by Spark; the catalog itself is a
table that is replaced as a whole by a rename.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.checks import IntegrityError, content_equal


def canonical_json(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False, default=str)


def stable_fingerprint(value: Any) -> str:
    """SHA-256 of sorted compact JSON."""
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def same_json(a: Any, b: Any) -> bool:
    """Strict equality of JSON values: tuples are lists, true isn't 1, arrays keep their order."""
    if isinstance(a, (list, tuple)) and isinstance(b, (list, tuple)):
        return len(a) == len(b) and all(map(same_json, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same_json(a[k], b[k]) for k in a)
    return type(a) is type(b) and a == b if isinstance(a, bool) or isinstance(b, bool) else a == b and not (isinstance(a, (list, tuple, dict)) or isinstance(b, (list, tuple, dict)))


def write_json(path: str, value: Any) -> None:
    """Write sorted JSON by a rename; NaN is an error."""
    text = json.dumps(value, sort_keys=True, indent=2, allow_nan=False, default=str)
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(part, "w") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, path)


def manifests(df: DataFrame, event_type: str) -> DataFrame:
    """A row per file of a table read with its files: path, size, row count, bounds, content hash of its rows.

    The content hash is the sum of the rows' 64-bit hashes, so it needs no order and no gathering.
    """
    return (
        df.withColumns({"__f": F.col("_metadata.file_path"), "__s": F.col("_metadata.file_size")})
        .groupBy(F.col("__f").alias("file_path"), "capture_session_id", "symbol")
        .agg(
            F.max("__s").alias("file_size"),
            F.count(F.lit(1)).alias("row_count"),
            F.min("capture_seq").alias("first_capture_seq"),
            F.max("capture_seq").alias("last_capture_seq"),
            F.min("local_time").alias("start_local_time"),
            F.max("local_time").alias("end_local_time"),
            F.sum(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")).alias("content_hash"),
        )
        .withColumn("event_type", F.lit(event_type))
    )


def select_sessions(catalog: DataFrame, symbol: str | None = None, start=None, end=None) -> DataFrame:
    """Manifests of every session with a file that overlaps [start, end)."""
    fits = F.lit(True) if symbol is None else F.col("symbol") == symbol.upper()
    own = catalog.where(fits)
    hit = own
    if start is not None:
        hit = hit.where(F.col("end_local_time") >= F.lit(start))
    if end is not None:
        hit = hit.where(F.col("start_local_time") < F.lit(end))
    return own.join(hit.select("capture_session_id").distinct(), "capture_session_id", "left_semi")


def freeze(catalog: DataFrame) -> dict:
    """A content-addressed selection: files with hashes, symbols, types, time range, and its fingerprint."""
    rows = [r.asDict() for r in catalog.orderBy("capture_session_id", "first_capture_seq", "file_path").collect()]
    if not rows:
        raise IntegrityError("cannot freeze an empty selection")
    paths = [r["file_path"] for r in rows]
    if len(set(paths)) != len(paths):
        raise IntegrityError("duplicate files in the selection")
    body = {
        "files": rows,
        "symbols": sorted({r["symbol"] for r in rows}),
        "event_types": sorted({r["event_type"] for r in rows}),
        "time_range": [min(r["start_local_time"] for r in rows), max(r["end_local_time"] for r in rows)],
    }
    body = json.loads(canonical_json(body))
    return {**body, "fingerprint": stable_fingerprint(body)}


def verify_frozen(frozen: dict, catalog: DataFrame) -> None:
    """Raise unless the files are as they were frozen."""
    body = {k: v for k, v in frozen.items() if k != "fingerprint"}
    if stable_fingerprint(body) != frozen["fingerprint"]:
        raise IntegrityError("the frozen selection was changed")
    wanted = {r["file_path"] for r in frozen["files"]}
    if freeze(catalog.where(F.col("file_path").isin(list(wanted))))["fingerprint"] != frozen["fingerprint"]:
        raise IntegrityError("a frozen file was changed")


def recovery(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """(file_path, problem): files the catalog misses, entries without a file, entries there twice."""
    missing = catalog.join(files, "file_path", "left_anti").select("file_path", F.lit("MISSING").alias("problem"))
    orphan = files.join(catalog, "file_path", "left_anti").select("file_path", F.lit("ORPHAN").alias("problem"))
    twice = catalog.groupBy("file_path").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("file_path", F.lit("DUPLICATE").alias("problem"))
    return missing.distinct().unionByName(orphan.distinct()).unionByName(twice)


def compaction_bins(catalog: DataFrame, max_files: int = 100, max_bytes: int = 64_000_000, max_rows: int = 200_000) -> DataFrame:
    """``catalog`` with ``bin``: greedy packing in capture order per session, symbol and type."""
    keys = ["capture_session_id", "symbol", "event_type"]
    if not catalog.where((F.col("file_size") > max_bytes) | (F.col("row_count") > max_rows)).isEmpty():
        raise IntegrityError("a single file exceeds the compaction bounds")

    def pack(pdf):
        pdf = pdf.sort_values(["first_capture_seq", "file_path"])
        own, n, size, rows, out = 0, 0, 0, 0, []
        for f in pdf.itertuples():
            if n and (n >= max_files or size + f.file_size > max_bytes or rows + f.row_count > max_rows):
                own, n, size, rows = own + 1, 0, 0, 0
            n, size, rows = n + 1, size + f.file_size, rows + f.row_count
            out.append(own)
        return pdf.assign(bin=out)

    return catalog.groupBy(*keys).applyInPandas(pack, T.StructType([*catalog.schema.fields, T.StructField("bin", T.LongType())]))


def compact(spark: SparkSession, source: str, destination: str, keys: list[str], order: str = "capture_seq", rows_per_file: int = 200_000) -> int:
    """Rewrite a table in few sorted files in a new folder, and compare contents; the source stays."""
    table = spark.read.parquet(source)
    total = table.count()
    parts = max(1, -(-total // rows_per_file))
    table.repartitionByRange(parts, *keys, order).sortWithinPartitions(*keys, order).write.mode("errorifexists").parquet(destination)
    made = spark.read.schema(table.schema).parquet(destination)
    if not content_equal(table, made):
        raise IntegrityError("compaction changed the content")
    return parts


def compact_bins(spark: SparkSession, source: str | DataFrame, bins: DataFrame, destination: str, order: str = "capture_seq") -> DataFrame:
    """Rewrite the files of ``source`` (a folder, or the table read from it) as one sorted file for each session, symbol, type and ``bin`` of ``bins``
    (see `compaction_bins`) in a new folder, compare contents, and return the new table (its partitions: session, symbol, type, bin)."""
    table = spark.read.parquet(source) if isinstance(source, str) else source
    own = ["capture_session_id", "symbol", "event_type", "bin"]
    placed = table.withColumn("__f", F.col("_metadata.file_path")).join(bins.select(F.col("file_path").alias("__f"), *[F.col(c).alias(f"of_{c}") for c in own]), "__f").drop("__f")
    parts = [f"of_{c}" for c in own]
    placed.repartition(*parts).sortWithinPartitions(*parts, order).write.partitionBy(*parts).mode("errorifexists").parquet(destination)
    made = spark.read.schema(placed.schema).parquet(destination)
    if not content_equal(table, made.select(*table.columns)):
        raise IntegrityError("compaction changed the content")
    return made


def ordered_digest(df: DataFrame, keys: list[str], order: str = "capture_seq", size: int = 1 << 14) -> DataFrame:
    """keys, digest: SHA-256 over the rows in order, in two levels (pieces of rows, then pieces)."""
    line = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    pieces = df.select(*keys, F.expr(f"{order} div {size}").alias("__p"), F.col(order).alias("__o"), line.alias("__h"))
    part = pieces.groupBy(*keys, "__p").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__o", "__h"))), lambda x: x["__h"]), ""), 256).alias("__d"))
    return part.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__p", "__d"))), lambda x: x["__d"]), ""), 256).alias("digest"))


def storage_projection(catalog: DataFrame) -> DataFrame:
    """event_type, files, bytes, rows, gb_per_hour, gb_per_day over the catalog's time range."""
    span = catalog.agg(((F.max(F.unix_micros("end_local_time")) - F.min(F.unix_micros("start_local_time"))) / 1e6).alias("seconds"))
    sums = catalog.groupBy("event_type").agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"), F.sum("row_count").alias("rows"))
    seconds = span.first()["seconds"]
    rate = F.lit(None).cast("double") if not seconds else F.col("bytes") / F.lit(seconds) * 3600 / 1e9
    return sums.withColumns({"gb_per_hour": rate, "gb_per_day": rate * 24})
