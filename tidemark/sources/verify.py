"""Verification of a dataset's files against their manifests, at the size of the catalog.

Executors read whole files (a recorder's files are bounded by rows and bytes), and from each take its SHA-256, its
Parquet footer and what its rows say of themselves.  Everything after that is joins of one row a file.
A selection is frozen as a table whose name is the root of a hash tree over its files.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.checks import IntegrityError, with_previous
from tidemark.sources.projections import KEYS
from tidemark.streaming.sink import Folder

DATASET_VERSION = 1
FACTS = (
    "file_path string, file_size bigint, sha256 string, problem string, rows bigint, columns string, first_seq bigint, last_seq bigint, rising boolean, "
    "symbols array<string>, sessions array<string>, schema_versions array<bigint>, dataset_versions array<bigint>"
)
_ROW_COLUMNS = {"symbols": "symbol", "sessions": "capture_session_id", "schema_versions": "schema_version", "dataset_versions": "dataset_version"}


def _facts(path: str, size: int, content: bytes) -> dict:
    """What a file is; ``problem`` if it isn't readable Parquet."""
    out = dict.fromkeys((c.split()[0] for c in FACTS.split(", ")), None) | {"file_path": path, "file_size": size, "sha256": hashlib.sha256(content).hexdigest()}
    try:
        file = pq.ParquetFile(io.BytesIO(content))
        names = file.schema_arrow.names
        out |= {"rows": file.metadata.num_rows, "columns": ",".join(f"{f.name}:{f.type}" for f in file.schema_arrow)}
        table = file.read([c for c in ("capture_seq", *_ROW_COLUMNS.values()) if c in names])
    except Exception as e:  # noqa: BLE001  whatever is wrong with a file is its finding
        return out | {"problem": f"{type(e).__name__}"}
    if "capture_seq" in names and table.num_rows:
        seq = table["capture_seq"].to_numpy()
        out |= {"first_seq": int(seq[0]), "last_seq": int(seq[-1]), "rising": bool((np.diff(seq) > 0).all())}
    return out | {k: sorted(table[c].unique().drop_null().to_pylist()) for k, c in _ROW_COLUMNS.items() if c in names}


def file_facts(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """A row for each file below ``root``, see ``FACTS``; paths are relative."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    relative = F.substring_index("path", root.rstrip("/").removeprefix("file:") + "/", -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_facts(*(b.column(i)[k].as_py() for i in range(3))) for k in range(b.num_rows)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = to_arrow_schema(T.StructType.fromDDL(FACTS))
    return files.select(relative.alias("path"), "length", "content").mapInArrow(run, FACTS)


def violations(manifests: DataFrame, facts: DataFrame, columns: str | dict[str, str]) -> DataFrame:
    """(file_path, error) for each fault of each manifest.

    ``manifests``: file_path, event_type, symbol, capture_session_id, dataset_version, schema_version, row_count, file_size, sha256 (or null),
    first_capture_seq, last_capture_seq.  ``columns``: the schema a file must have, as in ``FACTS``, or one by event type.  Errors:
    VERSION, EMPTY, ESCAPES, DUPLICATE, MISSING, CHECKSUM, CORRUPT, SCHEMA, SIZE, ROWS, IDENTITY, ORDER, BOUNDS; UNLISTED files have no manifest.
    """
    wanted: Column = F.lit(columns) if isinstance(columns, str) else F.create_map(*[F.lit(x) for kv in columns.items() for x in kv])[F.col("event_type")]
    twice = manifests.groupBy("file_path").agg(F.count(F.lit(1)).alias("__times"))
    joined = manifests.alias("m").join(facts.alias("f"), F.col("m.file_path") == F.col("f.file_path"), "left").join(twice.alias("t"), F.col("m.file_path") == F.col("t.file_path"))
    there, sound = F.col("f.file_path").isNotNull(), F.col("f.problem").isNull() & F.col("f.file_path").isNotNull()
    only = lambda c, m: (F.size(f"f.{c}") == 1) & (F.get(f"f.{c}", F.lit(0)) == F.col(f"m.{m}"))
    identity = only("symbols", "symbol") & only("sessions", "capture_session_id") & only("schema_versions", "schema_version") & only("dataset_versions", "dataset_version")
    no = lambda c: ~F.coalesce(c, F.lit(False))
    tests = {
        "VERSION": no(F.col("m.dataset_version") == DATASET_VERSION),
        "EMPTY": no(F.col("m.row_count") > 0),
        "ESCAPES": F.col("m.file_path").startswith("/") | F.col("m.file_path").rlike(r"(^|/)\.\.(/|$)"),
        "DUPLICATE": F.col("__times") > 1,
        "MISSING": ~there,
        "CHECKSUM": there & F.col("m.sha256").isNotNull() & no(F.col("m.sha256") == F.col("f.sha256")),
        "CORRUPT": F.col("f.problem").isNotNull(),
        "SCHEMA": sound & no(F.col("f.columns") == wanted),
        "SIZE": there & no(F.col("m.file_size") == F.col("f.file_size")),
        "ROWS": sound & no(F.col("m.row_count") == F.col("f.rows")),
        "IDENTITY": sound & no(identity),
        "ORDER": sound & no(F.col("f.rising")),
        "BOUNDS": sound & no((F.col("m.first_capture_seq") == F.col("f.first_seq")) & (F.col("m.last_capture_seq") == F.col("f.last_seq"))),
    }
    found = joined.select(F.col("m.file_path").alias("file_path"), F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tests.items()]))).alias("error")).distinct()
    return found.unionByName(facts.join(manifests, "file_path", "left_anti").select("file_path", F.lit("UNLISTED").alias("error")))


def sequence_faults(rows: DataFrame, required: list[str], keys: list[str] | None = None) -> DataFrame:
    """(keys, error, capture_seq) of merged event rows (keys, event_type, capture_seq, monotonic_ns): event types of
    ``required`` that a series lacks, sequence numbers there twice, clocks that go back."""
    keys = keys or KEYS
    has = rows.groupBy(*keys).agg(F.collect_set("event_type").alias("has"))
    lacking = has.select(*keys, F.explode(F.array_except(F.array(*map(F.lit, required)), "has")).alias("t")).select(*keys, F.concat(F.lit("LACKS "), F.col("t")).alias("error"), F.lit(None).cast("bigint").alias("capture_seq"))
    twice = rows.groupBy(*keys, "capture_seq").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys, F.lit("DUPLICATE").alias("error"), "capture_seq")
    back = with_previous(rows.select(*keys, "capture_seq", "monotonic_ns"), ["monotonic_ns"], keys).where("monotonic_ns < prev_monotonic_ns").select(*keys, F.lit("CLOCK_BACK").alias("error"), "capture_seq")
    return lacking.unionByName(twice).unionByName(back)


def merkle_root(files: DataFrame, fan: int = 4096) -> str:
    """The root over (file_path, sha256): leaves by path, dealt to buckets by their hash, buckets hashed in order.

    A bucket holds about ``fan`` leaves, so buckets grow with the files, and levels with their logarithm.
    """
    leaves = files.select(F.sha2(F.concat_ws("\n", "file_path", "sha256"), 256).alias("h"))
    n = leaves.count()
    digits = 0
    while fan * 16**digits < n:
        digits += 1
    for k in range(digits, -1, -1):
        leaves = leaves.groupBy(F.substring("h", 1, k).alias("at")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("d")).select(F.concat("at", F.substring("d", k + 1, 64)).alias("h"))
    return hashlib.sha256(f"{n}:{''.join(r.h for r in leaves.collect())}".encode()).hexdigest()


def freeze(selection: DataFrame, root: str) -> str:
    """Keep a selection (manifests with sha256) as the table ``root``/<id>; its id is its hash tree's root.

    Freezing the same files again gives the same id and leaves the table as it is.
    """
    spark = selection.sparkSession
    if selection.isEmpty():
        raise IntegrityError("cannot freeze an empty selection")
    if not selection.groupBy("file_path").count().where("count > 1").isEmpty():
        raise IntegrityError("duplicate files in the selection")
    if not selection.where("sha256 is null").isEmpty():
        raise IntegrityError("a selected file has no digest")
    name = merkle_root(selection)
    folder = Folder(spark, root)
    if not folder.exists(name):
        stage = f".{name}.tmp"
        selection.write.mode("overwrite").parquet(f"{root}/{stage}")
        folder.rename(stage, name)
    return name


def frozen_violations(spark: SparkSession, root: str, name: str, facts: DataFrame) -> DataFrame:
    """(file_path, error): frozen files that are gone or changed; one row CHANGED_SELECTION if the table isn't what its name says."""
    table = spark.read.parquet(f"{root}/{name}")
    f = facts.select("file_path", F.col("sha256").alias("now"))
    files = table.join(f, "file_path", "left").select("file_path", F.when(F.col("now").isNull(), "MISSING").when(F.col("now") != F.col("sha256"), "CHECKSUM").alias("error")).where("error is not null")
    if merkle_root(table) != name:
        return files.unionByName(spark.createDataFrame([(None, "CHANGED_SELECTION")], files.schema))
    return files


def register(spark: SparkSession, root: str, manifests: DataFrame) -> int:
    """Add manifests (with dataset_id) to the catalog ``root`` as its next version, and return that; an id that is there already
    is an error.  A version is staged and made visible by a rename, so two writers of one version can't both succeed."""
    folder = Folder(spark, root)
    own = manifests.persist()
    try:
        version = max([int(n) for n in folder.names("versions")], default=0) + 1
        every = own if version == 1 else entries(spark, root).unionByName(own)
        if not every.groupBy("dataset_id").count().where("count > 1").isEmpty():
            raise IntegrityError("a dataset id is registered already")
        stage = f"staging/{version}-{uuid.uuid4().hex}"
        own.sort("first_capture_seq", "file_path").write.parquet(f"{root}/{stage}")
        if not folder.rename(stage, f"versions/{version}"):
            folder.remove(stage)
            raise IntegrityError(f"version {version} of the catalog was written meanwhile")
        return version
    finally:
        own.unpersist()


def entries(spark: SparkSession, root: str, session: str | None = None) -> DataFrame:
    """The catalog's manifests, or those of one session."""
    names = Folder(spark, root).names("versions")
    if not names:
        raise IntegrityError(f"no catalog at {root}")
    out = spark.read.parquet(*[f"{root}/versions/{n}" for n in names])
    return out if session is None else out.where(F.col("capture_session_id") == session)


def frozen_sources(spark: SparkSession, root: str, paths: DataFrame) -> DataFrame:
    """The rows of ``paths`` (file_path) that some frozen selection of ``root`` holds: they may not be removed or rewritten."""
    names = [n for n in Folder(spark, root).names(".") if not n.startswith(".")]
    if not names:
        return paths.limit(0)
    return paths.join(spark.read.parquet(*[f"{root}/{n}" for n in names]).select("file_path"), "file_path", "left_semi")


def unfinished_sessions(selection: DataFrame, summaries: DataFrame) -> DataFrame:
    """(capture_session_id, error): selected sessions without a summary (MISSING), or whose summary isn't final and valid (UNFINISHED).
    ``summaries``: capture_session_id, status, dataset_valid."""
    joined = selection.select("capture_session_id").distinct().join(summaries, "capture_session_id", "left")
    final = F.coalesce((F.col("status") == "FINALIZED") & F.col("dataset_valid"), F.lit(False))
    return joined.select("capture_session_id", F.when(F.col("status").isNull(), "MISSING").when(~final, "UNFINISHED").alias("error")).where("error is not null")
