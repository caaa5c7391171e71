"""Feature tables by version: schemas from a rule, decoding to nested values and back, keyed lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.checks import IntegrityError

DEPTHS = (1, 5, 10)
WINDOWS = (1, 5, 10)
VERSIONS = (1, 2)
#: What a column is called in version 1, where it is called otherwise.
_OLD_NAMES = ("trade_event_count", "aggregate_trade_event_count")
_HEAD = "dataset_version smallint, schema_version smallint, capture_session_id string, capture_seq bigint, exchange string, market_type string, symbol string, event_time timestamp, local_receive_time timestamp, created_at timestamp, monotonic_ns bigint, book_last_update_id bigint"
#: Groups of columns: nested name, and its fields with types.  ``{}`` takes the depth or window.
_GROUPS: dict[str, dict[str, str]] = {
    "book": dict.fromkeys(("best_bid_price", "best_bid_quantity", "best_ask_price", "best_ask_quantity", "mid_price", "spread"), "string") | {"spread_bps": "double", "microprice": "string", "microprice_offset": "string", "microprice_offset_bps": "double"},
    "returns": dict.fromkeys(("return_250ms", "return_1s", "return_5s", "return_10s"), "double"),
    "volatility": dict.fromkeys(("realized_volatility_1s", "realized_volatility_5s", "realized_volatility_10s"), "double"),
    "health": dict.fromkeys(("book_age_ms", "trade_stream_age_ms", "corrected_exchange_lag_ms"), "double") | dict.fromkeys(("book_healthy", "trade_stream_healthy", "clock_sync_healthy"), "boolean"),
}
_DEPTH = {"bid_volume": ("bid_volume_l{}", "string"), "ask_volume": ("ask_volume_l{}", "string"), "imbalance": ("book_imbalance_l{}", "double")}
_FLOW = {
    "aggressive_buy_volume": ("aggressive_buy_volume_{}s", "string"), "aggressive_sell_volume": ("aggressive_sell_volume_{}s", "string"), "signed_volume": ("signed_volume_{}s", "string"), "total_volume": ("total_volume_{}s", "string"),
    "trade_event_count": ("trade_event_count_{}s", "bigint"), "trade_imbalance": ("trade_imbalance_{}s", "double"), "buy_ratio": ("buy_ratio_{}s", "double"), "volume_weighted_price": ("volume_weighted_price_{}s", "string"),
}
_TAIL = "feature_valid boolean, invalid_reasons array<string>"
_DECIMAL = "decimal(38,18)"


def _columns() -> list[str]:
    group = lambda g: [f"{n} {t}" for n, t in _GROUPS[g].items()]
    keyed = lambda fields, keys: [f"{n.format(k)} {t}" for k in keys for n, t in fields.values()]
    return [_HEAD, *group("book"), *keyed(_DEPTH, DEPTHS), *group("returns"), *group("volatility"), *keyed(_FLOW, WINDOWS), *group("health"), _TAIL]


def feature_schema(version: int) -> T.StructType:
    """The flat schema of a version; another version is an error."""
    if version not in VERSIONS:
        raise KeyError(f"no feature schema of version {version}")
    text = ", ".join(_columns())
    return T.StructType.fromDDL(text.replace(*_OLD_NAMES) if version == 1 else text)


def _value(name: str, kind: str) -> Column:
    """Strings are exact decimals."""
    return F.col(name).cast(_DECIMAL) if kind == "string" else F.col(name)


def decode(flat: DataFrame, version: int) -> DataFrame:
    """Nested features of a flat table of ``version``: structs book, returns, volatility, health; maps ``depth`` by levels and ``flow`` by seconds
    (whose ``available`` says whether the window had trades to speak of)."""
    if version == 1:
        flat = flat.withColumnsRenamed({c: c.replace(*reversed(_OLD_NAMES)) for c in flat.columns if _OLD_NAMES[1] in c})
    elif version not in VERSIONS:
        raise KeyError(f"no feature schema of version {version}")
    head = [f.name for f in T.StructType.fromDDL(_HEAD)]
    structs = [F.struct(*[_value(n, t).alias(n) for n, t in fields.items()]).alias(g) for g, fields in _GROUPS.items()]
    entry = lambda fields, k: [_value(n.format(k), t).alias(f) for f, (n, t) in fields.items()]
    depth = F.create_map(*[x for k in DEPTHS for x in (F.lit(k), F.struct(*entry(_DEPTH, k)))]).alias("depth")
    flow = F.create_map(*[x for k in WINDOWS for x in (F.lit(k), F.struct(F.col(f"total_volume_{k}s").isNotNull().alias("available"), *entry(_FLOW, k)))]).alias("flow")
    return flat.select(*head, *structs, depth, flow, "feature_valid", "invalid_reasons")


def flatten(nested: DataFrame) -> DataFrame:
    """The flat table, in the latest version, of what `decode` gives; decimals as plain text."""

    def text(c: Column, kind: str) -> Column:
        whole = c.cast("string")
        return F.when(whole.contains("."), F.regexp_replace(whole, r"\.?0+$", "")).otherwise(whole) if kind == "string" else c

    made = {n: text(F.col(g)[n], t) for g, fields in _GROUPS.items() for n, t in fields.items()}
    for fields, keys, column in ((_DEPTH, DEPTHS, "depth"), (_FLOW, WINDOWS, "flow")):
        made |= {n.format(k): text(F.element_at(column, F.lit(k))[f], t) for k in keys for f, (n, t) in fields.items()}
    made["schema_version"] = F.lit(VERSIONS[-1]).cast("smallint")
    return nested.select(*[made.get(f.name, F.col(f.name)).alias(f.name) for f in feature_schema(VERSIONS[-1])])


def feature_value(name: str) -> Column:
    """A feature of the nested table by its research name; an unknown name is an error."""
    short = {f"rv_{w}": ("volatility", f"realized_volatility_{w}") for w in ("1s", "5s", "10s")} | {n: ("returns", n) for n in ("return_250ms", "return_1s")} | {"microprice_offset_bps": ("book", "microprice_offset_bps")}
    if name in short:
        group, field = short[name]
        return F.col(group)[field].alias(name)
    keyed = {f"imbalance_l{k}": ("depth", k, "imbalance") for k in DEPTHS} | {f"trade_imbalance_{k}s": ("flow", k, "trade_imbalance") for k in (1, 5)}
    if name not in keyed:
        raise KeyError(f"unknown feature {name}")
    column, k, field = keyed[name]
    return F.element_at(column, F.lit(k))[field].alias(name)


def feature_scan(spark: SparkSession, paths: dict[int, list[str]], session: str | None = None, symbol: str | None = None) -> DataFrame:
    """Nested features of files by version.  Rows must say the version of their files; no file, or a row of another
    version, is an error.  Filters of session and symbol reach the files."""
    parts = []
    for version, files in paths.items():
        flat = spark.read.schema(feature_schema(version)).parquet(*files)
        if session is not None:
            flat = flat.where(F.col("capture_session_id") == session)
        if symbol is not None:
            flat = flat.where(F.col("symbol") == symbol.strip().upper())
        said = F.col("schema_version") == version
        parts.append(decode(flat, version).withColumn("schema_version", F.when(said, F.col("schema_version")).otherwise(F.raise_error(F.lit(f"a row of another version among files of version {version}")).cast("smallint"))))
    if not parts:
        raise IntegrityError("no recorded features")
    return reduce(DataFrame.unionByName, parts)
