"""Queries of file sets made from the event table: verification with planted faults, compaction."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import own_folder, shared_table
from tidemark.sources import catalog, projections, verify

from .oracle import OBS, with_

_KINDS = ("click", "view", "purchase", "signup", "error")
#: What is wrong with the file number (5 * symbol + kind), and what is found.
_PLANTED = {1: ("VERSION", "IDENTITY"), 2: ("ROWS",), 3: ("CHECKSUM",), 4: ("SIZE",), 5: ("BOUNDS",), 6: ("IDENTITY",), 7: ("MISSING", "UNLISTED"), 8: ("ORDER", "BOUNDS"), 9: ("SCHEMA",), 10: ("ESCAPES", "MISSING", "UNLISTED"), 11: ("EMPTY", "ROWS"), 12: ("DUPLICATE",)}


def _number(symbol: str, kind: str) -> Column:
    return F.substring(symbol, 4, 9).cast("int") * 5 + F.array_position(F.array(*map(F.lit, _KINDS)), F.col(kind)).cast("int") - 1


def manifest_violations(spark: SparkSession, d: str) -> DataFrame:
    """One file a symbol and kind, with manifests of which some are wrong: what verification finds."""
    obs = projections.observations(spark, d).withColumns({"schema_version": F.lit(1), "dataset_version": F.lit(1), "n": _number("symbol", "event_type")})
    root = f"{own_folder(spark)}/files-{uuid.uuid4().hex}"
    order = F.when(F.col("n") == 8, -F.col("capture_seq")).otherwise(F.col("capture_seq"))
    rows = obs.select("capture_session_id", "symbol", "event_type", "capture_seq", "schema_version", "dataset_version", "qty", "n", F.col("symbol").alias("of_symbol"), F.col("event_type").alias("of_kind"))
    rows.repartition("of_symbol", "of_kind").sortWithinPartitions("of_symbol", "of_kind", order).drop("n").write.partitionBy("of_symbol", "of_kind").parquet(root)
    facts = verify.file_facts(spark, root)
    own = {c: F.regexp_extract("file_path", f"of_{c}=([^/]*)/", 1) for c in ("symbol", "kind")}
    named = facts.select("file_path", "file_size", "sha256", *[v.alias(c) for c, v in own.items()])
    sums = rows.groupBy(F.col("symbol").alias("symbol"), F.col("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("row_count"), F.min("capture_seq").alias("first_capture_seq"), F.max("capture_seq").alias("last_capture_seq"))
    n = _number("symbol", "kind")
    at = lambda k, wrong, right: F.when(n == k, wrong).otherwise(right)
    manifests = named.join(sums, ["symbol", "kind"]).select(
        at(7, F.concat(F.lit("gone/"), "file_path"), at(10, F.concat(F.lit("../"), "file_path"), F.col("file_path"))).alias("file_path"),
        at(9, F.lit("other"), F.lit("event")).alias("event_type"), at(6, F.lit("OTHER"), F.col("symbol")).alias("symbol"), F.lit("S0").alias("capture_session_id"),
        at(1, F.lit(2), F.lit(1)).alias("dataset_version"), F.lit(1).alias("schema_version"), at(2, F.col("row_count") + 1, at(11, F.lit(0), F.col("row_count"))).alias("row_count"),
        at(4, F.col("file_size") + 1, F.col("file_size")).alias("file_size"), at(3, F.lit("0"), F.col("sha256")).alias("sha256"), "first_capture_seq", at(5, F.col("last_capture_seq") + 1, F.col("last_capture_seq")).alias("last_capture_seq"), n.alias("n"),
    )
    columns = "capture_session_id:string,symbol:string,event_type:string,capture_seq:int64,schema_version:int32,dataset_version:int32,qty:decimal128(18, 8)"
    found = verify.violations(manifests.unionByName(manifests.where("n = 12")).drop("n"), facts, {"event": columns})
    return found.select(own["symbol"].alias("symbol"), own["kind"].alias("kind"), "error")


def compaction_equivalence(spark: SparkSession, d: str) -> DataFrame:
    """Files of 500 numbers of a symbol, three of them a bin, rewritten as one file a bin: what each new file holds."""
    obs = projections.observations(spark, d).withColumns({"local_time": F.col("ts"), "cut": F.expr("capture_seq div 500")})
    folder = f"{own_folder(spark)}/compaction-{uuid.uuid4().hex}"
    rows = obs.select("capture_session_id", "symbol", "event_type", "capture_seq", "local_time", "qty", "cut", F.col("symbol").alias("of"))
    rows.repartition("of", "cut").sortWithinPartitions("of", "cut", "capture_seq").write.partitionBy("of", "cut").parquet(f"{folder}/in")
    # the folder is listed once, and each of its files is opened once for its manifest
    table = spark.read.schema(rows.schema).parquet(f"{folder}/in")
    files = shared_table(catalog.manifests(table, "event"), "manifests")
    made = catalog.compact_bins(spark, table, catalog.compaction_bins(files, max_files=3), f"{folder}/out")
    per_file = made.withColumn("f", F.col("_metadata.file_path")).groupBy("symbol", F.col("of_bin").cast("bigint").alias("bin"))
    return per_file.agg(F.countDistinct("f").alias("files"), F.count(F.lit(1)).alias("rows"), F.min("capture_seq").alias("first_seq"), F.max("capture_seq").alias("last_seq"))


QUERIES = {"manifest_violations": manifest_violations, "compaction_equivalence": compaction_equivalence}
_errors = ", ".join(f"({n}, '{e}')" for n, errors in _PLANTED.items() for e in errors)
_numbers = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(_KINDS))
SQL = {
    "manifest_violations": f"""{with_(OBS)} SELECT f.symbol, f.event_type AS kind, p.error FROM (SELECT DISTINCT symbol, event_type, 5 * CAST(substr(symbol, 4) AS INT) + CASE event_type {_numbers} END AS n FROM obs) f JOIN (VALUES {_errors}) p(n, error) USING (n)""",
    "compaction_equivalence": f"""{with_(OBS)}, placed AS (SELECT symbol, capture_seq, (dense_rank() OVER (PARTITION BY symbol ORDER BY capture_seq // 500) - 1) // 3 AS bin FROM obs)
        SELECT symbol, bin, CAST(1 AS BIGINT) AS files, count(*) AS rows, min(capture_seq) AS first_seq, max(capture_seq) AS last_seq FROM placed GROUP BY symbol, bin""",
}
