"""The transactional sink cut off at each step; each fault of a manifest; frozen selections."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.checks import IntegrityError
from tidemark.sources import verify
from tidemark.streaming import counts, sink

ROWS = "capture_session_id string, symbol string, event_type string, capture_seq bigint, ts timestamp, value double"


def table(spark, n=200):
    return spark.range(n).select(F.lit("S").alias("capture_session_id"), F.concat(F.lit("SYM"), F.col("id") % 3).alias("symbol"), F.lit("trade").alias("event_type"), F.col("id").alias("capture_seq"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), (F.col("id") / 7).alias("value"))


@pytest.mark.parametrize("step", sink.STEPS)
def test_cut_off_batches_leave_one_copy(spark, tmp_path, step):
    rows = table(spark)
    for i in range(3):
        rows.where(F.expr(f"capture_seq div 70 = {i}")).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    ended = []

    def told(at, batch_id):
        if at == step and batch_id == 1 and not ended:
            ended.append(batch_id)
            raise RuntimeError("the power went off")

    own = sink.TransactionalSink(str(tmp_path / "sink"), ["symbol"], rows_per_file=30, told=told)
    run = lambda: own.start(counts.stream_of(spark, str(tmp_path / "in" / "*"), rows.schema, 1), str(tmp_path / "cp")).awaitTermination()
    with pytest.raises(Exception, match="power"):
        run()
    assert ended == [1] and own.committed(spark) == ([0, 1] if step == "committed" else [0])
    files = len(list((tmp_path / "in").rglob("*.parquet")))
    run()
    got = own.read(spark)
    assert got.select(*rows.columns).exceptAll(rows).isEmpty() and got.count() == rows.count()
    assert own.committed(spark) == list(range(files)) and os.listdir(tmp_path / "sink" / "staging") == []
    listed = own.read(spark, "manifest")
    assert listed.agg(F.sum("rows")).first()[0] == rows.count() and listed.agg(F.max("rows")).first()[0] <= 30
    own.write(rows, 1)
    assert own.read(spark).count() == rows.count()


def dataset(spark, root):
    """Three files of 20 rows, and their manifests."""
    rows = table(spark, 60).withColumns({"schema_version": F.lit(1), "dataset_version": F.lit(1)})
    rows.repartition(1, "symbol").sortWithinPartitions("symbol", "capture_seq").withColumn("part", F.col("symbol")).write.partitionBy("part").parquet(root)
    for p in Path(root).rglob(".*.crc"):  # else the local file system itself finds that a file was changed
        p.unlink()
    verify.file_facts(spark, root).write.parquet(f"{root}-facts")
    facts = spark.read.parquet(f"{root}-facts")
    manifests = facts.select(
        "file_path", F.lit("trade").alias("event_type"), F.get("symbols", F.lit(0)).alias("symbol"), F.lit("S").alias("capture_session_id"), F.lit(1).alias("dataset_version"), F.lit(1).alias("schema_version"),
        F.col("rows").alias("row_count"), "file_size", "sha256", F.col("first_seq").alias("first_capture_seq"), F.col("last_seq").alias("last_capture_seq"),
    )
    return facts, manifests


def test_each_fault_of_a_manifest(spark, tmp_path):
    root = str(tmp_path / "raw")
    facts, manifests = dataset(spark, root)
    columns = facts.first()["columns"]
    find = lambda m, f=facts, c=columns: sorted({r["error"] for r in verify.violations(m, f, c).collect()})
    assert facts.count() == 3 and find(manifests) == []
    one = manifests.limit(1)
    changed = {
        "VERSION": {"dataset_version": F.lit(2)}, "EMPTY": {"row_count": F.lit(0)}, "CHECKSUM": {"sha256": F.lit("0")}, "SIZE": {"file_size": F.lit(1)},
        "ROWS": {"row_count": F.lit(19)}, "IDENTITY": {"symbol": F.lit("OTHER")}, "BOUNDS": {"last_capture_seq": F.lit(1000)},
    }
    rest = manifests.join(one.select("file_path"), "file_path", "left_anti")
    for error, change in changed.items():
        assert error in find(one.withColumns(change).unionByName(rest)), error
    assert find(rest) == ["UNLISTED"]
    assert find(manifests.unionByName(one)) == ["DUPLICATE"]
    assert find(manifests.unionByName(one.withColumn("file_path", F.lit("../x.parquet")))) == ["ESCAPES", "MISSING"]
    assert find(manifests, c="other:int64") == ["SCHEMA"] and find(manifests, c={"trade": columns}) == []
    path = next(p for p in sorted((tmp_path / "raw").rglob("*.parquet")))
    good = path.read_bytes()
    path.write_bytes(good[:-9])
    assert find(manifests, verify.file_facts(spark, root)) == ["CHECKSUM", "CORRUPT", "SIZE"]
    table(spark, 20).withColumns({"schema_version": F.lit(1), "dataset_version": F.lit(1)}).coalesce(1).orderBy(F.desc("capture_seq")).write.parquet(str(tmp_path / "o"))
    path.write_bytes(next((tmp_path / "o").rglob("*.parquet")).read_bytes())
    assert "ORDER" in find(manifests, verify.file_facts(spark, root))


def test_frozen_selection(spark, tmp_path):
    root, frozen = str(tmp_path / "raw"), str(tmp_path / "frozen")
    facts, manifests = dataset(spark, root)
    name = verify.freeze(manifests, frozen)
    assert verify.freeze(manifests.orderBy(F.desc("file_path")), frozen) == name and verify.frozen_violations(spark, frozen, name, facts).isEmpty()
    assert verify.merkle_root(manifests, fan=1) != verify.merkle_root(manifests.limit(2), fan=1)
    path = next(p for p in sorted((tmp_path / "raw").rglob("*.parquet")))
    path.write_bytes(path.read_bytes() + b"x")
    assert [r["error"] for r in verify.frozen_violations(spark, frozen, name, verify.file_facts(spark, root)).collect()] == ["CHECKSUM"]
    with pytest.raises(IntegrityError, match="duplicate"):
        verify.freeze(manifests.unionByName(manifests), frozen)
    manifests.limit(2).write.mode("overwrite").parquet(f"{frozen}/{name}")
    assert "CHANGED_SELECTION" in [r["error"] for r in verify.frozen_violations(spark, frozen, name, facts).collect()]


def test_faults_of_a_merged_load(spark):
    rows = [("S", "A", "depth", 0, 0), ("S", "A", "trade", 1, 5), ("S", "A", "trade", 1, 5), ("S", "A", "depth", 2, 4), ("S", "B", "trade", 3, 1)]
    got = verify.sequence_faults(spark.createDataFrame(rows, "capture_session_id string, symbol string, event_type string, capture_seq bigint, monotonic_ns bigint"), ["depth", "trade"]).collect()
    assert sorted((r.symbol, r.error, r.capture_seq) for r in got) == [("A", "CLOCK_BACK", 2), ("A", "DUPLICATE", 1), ("B", "LACKS depth", None)]
