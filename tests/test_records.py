"""Nested differences, nearest rows, cumulative distributions and feature tables against plain Python."""

from __future__ import annotations

import math
import random
from datetime import datetime
from decimal import Decimal as D
from statistics import median

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import distributions, nearest, nested
from tidemark.sources import features

NESTED = "id bigint, s struct<x:double,y:array<struct<p:decimal(18,8),q:double>>,m:map<string,array<double>>>, t string, n bigint"


def walked(a, b, path=""):
    """Paths where two Python values differ."""
    if isinstance(a, dict) and isinstance(b, dict):
        return [e for k in sorted({*a, *b}) for e in walked(a.get(k), b.get(k), f"{path}.{k}".lstrip("."))]
    if isinstance(a, list) and isinstance(b, list):
        return [path] if len(a) != len(b) else [e for i, (x, y) in enumerate(zip(a, b)) for e in walked(x, y, f"{path}[{i}]")]
    if isinstance(a, float) and isinstance(b, float):
        return [] if math.isclose(a, b, rel_tol=0, abs_tol=1e-12) else [path]
    return [] if a == b else [path]


def value(rng):
    real = lambda: rng.choice([1.0, 1.0, 1.0 + 1e-13, 2.5, None, float("nan"), float("inf")])
    level = lambda: None if rng.random() < 0.1 else {"p": rng.choice([D("1.00000000"), None]), "q": real()}
    s = {"x": real(), "y": rng.choice([None, [level() for _ in range(rng.choice([0, 2, 2]))]]), "m": rng.choice([None, {k: rng.choice([None, [real()]]) for k in rng.sample("abc", 2)}])}
    return None if rng.random() < 0.1 else s, rng.choice(["u", None]), rng.choice([1, 2])


def test_nested_differences(spark):
    rng = random.Random(8)
    left, right = ([(i, *value(rng)) for i in range(150)] for _ in range(2))
    left.append((200, None, None, None))
    frames = [spark.createDataFrame(rows, NESTED) for rows in (left, right)]
    got = {r.id: [d.path for d in r.differs] for r in nested.nested_differences(*frames, ["id"]).collect()}
    wanted = {200: ["missing"]}
    for (i, *a), (_, *b) in zip(left, right):
        found = walked(*({"s": v[0], "t": v[1], "n": v[2]} for v in (a, b)))
        if found:
            wanted[i] = sorted(found)
    assert {i: sorted(p) for i, p in got.items()} == wanted and len(wanted) > 50
    narrow = nested.nested_differences(frames[0].drop("t"), frames[0], ["id"]).select("id", "differs.path").collect()
    assert {tuple(r.path) for r in narrow if r.id < 150} <= {("t",), *[tuple(x) for x in [r.path for r in narrow]]} and sum("t" in r.path for r in narrow) == sum(r[2] is not None for r in left)


def test_nearest(spark):
    rng = random.Random(5)
    rows = [("S", rng.choice("ab"), i, rng.randint(-500, 500)) for i in range(120)]
    targets = [("S", rng.choice("abc"), i, rng.randint(-600, 600)) for i in range(200)]
    schema = "capture_session_id string, symbol string, capture_seq bigint, monotonic_ns bigint"
    got = nearest.nearest(spark.createDataFrame(targets, schema), spark.createDataFrame(rows, schema).withColumn("near_seq", F.col("capture_seq")), 20, ["near_seq"], chunk_ns=64)
    wanted = {}
    for _, s, i, t in targets:
        near = [(abs(ns - t), ns, q) for _, x, q, ns in rows if x == s and abs(ns - t) <= 20]
        wanted[i] = min(near)[1:] if near else (None, None)
    assert {r.capture_seq: (r.near_ns, r.near_seq) for r in got.collect()} == wanted and (None, None) in wanted.values()


@pytest.mark.parametrize(("every", "capacity"), [(10, 35), (7, 7), (50, 8), (1000, 6000)])
def test_cumulative_distributions(spark, every, capacity):
    rng = random.Random(every)
    rows = [("S", rng.choice("ab"), i, rng.choice([None, float("nan"), float("inf"), rng.randint(0, 99) / 4])) for i in range(300)]
    got = distributions.cumulative(spark.createDataFrame(rows, "capture_session_id string, symbol string, capture_seq bigint, v double"), "v", every=every, capacity=capacity)
    wanted = []
    for s in "ab":
        values = [(i, v) for _, x, i, v in rows if x == s and v is not None and math.isfinite(v)]
        for end in [*range(every, len(values), every), len(values)]:
            seen = [v for _, v in values[:end]]
            kept = sorted(seen[-capacity:])
            wanted.append((s, (end - 1) // every, values[end - 1][0], end, len(kept), sum(seen) / end, max(seen), median(kept), kept[int((len(kept) - 1) * 0.95)], kept[int((len(kept) - 1) * 0.99)]))
    names = ["symbol", "checkpoint", "last_seq", "count", "retained", "mean", "maximum", "p50", "p95", "p99"]
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(wanted)


def flat_rows(version, n, seed):
    rng = random.Random(seed)
    value = {"string": lambda: str(D(rng.randint(1, 10**9)).scaleb(-4).normalize().__format__("f")), "double": lambda: rng.random(), "bigint": lambda: rng.randint(0, 99), "smallint": lambda: 1, "boolean": lambda: rng.random() < 0.5, "timestamp": lambda: datetime(2026, 1, 1, 0, 0, rng.randint(0, 59)), "array<string>": lambda: rng.choice([[], ["BOOK_STALE"]])}
    schema = features.feature_schema(version)
    rows = []
    for i in range(n):
        row = {f.name: value[f.dataType.simpleString()]() if f.name in ("capture_session_id", "symbol") or rng.random() < 0.8 or f.dataType.simpleString() in ("array<string>", "boolean") else None for f in schema}
        rows.append(tuple((row | {"capture_seq": i, "schema_version": version, "symbol": "SYM", "capture_session_id": "S"})[f.name] for f in schema))
    return rows


def test_flatten_undoes_decode(spark):
    schema = features.feature_schema(2)
    assert len(schema) == 70 and features.feature_schema(1).names != schema.names
    flat = spark.createDataFrame(flat_rows(2, 40, 1), schema)
    again = features.flatten(features.decode(flat, 2))
    assert again.schema.names == schema.names and again.exceptAll(flat).isEmpty() and again.count() == 40
    one = spark.createDataFrame(flat_rows(1, 5, 2), features.feature_schema(1))
    flow = features.decode(one, 1).select(F.col("flow")[5]["trade_event_count"].alias("n"), "capture_seq").collect()
    assert {r.capture_seq: r.n for r in flow} == {r.capture_seq: r.aggregate_trade_event_count_5s for r in one.collect()}


def test_scan_and_lookup(spark, tmp_path):
    for v in features.VERSIONS:
        spark.createDataFrame(flat_rows(v, 6, v), features.feature_schema(v)).write.parquet(str(tmp_path / str(v)))
    paths = {v: [str(tmp_path / str(v))] for v in features.VERSIONS}
    scanned = features.feature_scan(spark, paths, session="S", symbol=" sym ")
    assert scanned.count() == 12 and isinstance(scanned.schema["depth"].dataType, T.MapType)
    names = ["imbalance_l1", "imbalance_l10", "trade_imbalance_1s", "trade_imbalance_5s", "return_250ms", "rv_10s", "microprice_offset_bps"]
    assert scanned.select(*[features.feature_value(n) for n in names]).columns == names
    for wrong in ("imbalance_l2", "trade_imbalance_10s", "mid"):
        with pytest.raises(KeyError):
            features.feature_value(wrong)
    with pytest.raises(KeyError):
        features.feature_schema(3)
    with pytest.raises(Exception, match="another version"):
        features.feature_scan(spark, {2: paths[1]}).collect()
    with pytest.raises(Exception, match="no recorded features"):
        features.feature_scan(spark, {})
