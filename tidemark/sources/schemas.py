"""Table schemas by event type and version, and readers that bring older versions up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEVELS = "array<struct<price:string,quantity:string>>"
COMMON = (
    "dataset_version smallint, schema_version smallint, capture_session_id string, capture_seq bigint, exchange string, market_type string, symbol string, "
    "exchange_time timestamp, local_time timestamp, monotonic_ns bigint"
)
_LIFECYCLE = "component string, kind string, reason string, resync_count bigint, sequence_gap_count bigint, healthy boolean"
_CLOCK = "offset_ms double, rtt_ms double, sampled_at timestamp"
#: Columns after the common ones, by (event type, version).  Fixed by the files' format.
PAYLOADS: dict[tuple[str, int], str] = {
    ("trade", 1): "trade_source string, aggregate_trade_id bigint, price string, quantity string, first_trade_id bigint, last_trade_id bigint, trade_time timestamp, aggressor_side string, buyer_is_maker boolean",
    ("depth", 1): f"transaction_time timestamp, first_update_id bigint, final_update_id bigint, previous_final_update_id bigint, bids {LEVELS}, asks {LEVELS}",
    ("trusted_book", 1): f"last_update_id bigint, snapshot_time timestamp, snapshot_monotonic_ns bigint, event_receive_time timestamp, event_receive_monotonic_ns bigint, bids {LEVELS}, asks {LEVELS}, state string, is_healthy boolean, book_age_ms double, resync_count bigint",
    ("stream_lifecycle", 1): _LIFECYCLE,
    ("stream_lifecycle", 2): f"{_LIFECYCLE}, connection_generation bigint, sync_generation bigint",
    ("book_lifecycle", 1): _LIFECYCLE,
    ("book_lifecycle", 2): f"{_LIFECYCLE}, connection_generation bigint, sync_generation bigint",
    ("clock_sample", 1): _CLOCK,
    ("clock_sample", 2): f"{_CLOCK}, local_send timestamp, local_receive timestamp, server_time_ms bigint, send_monotonic_ns bigint, receive_monotonic_ns bigint, accepted boolean",
    ("orderbook_bootstrap_snapshot", 1): f"connection_generation bigint, sync_generation bigint, request_start_time timestamp, request_start_monotonic_ns bigint, response_receive_time timestamp, response_receive_monotonic_ns bigint, exchange_transaction_time timestamp, last_update_id bigint, bids {LEVELS}, asks {LEVELS}, snapshot_limit int, resync_reason string, clock_offset_ms double, buffered_final_update_ids array<bigint>",
    ("runtime_sample", 1): "event_loop_lag_ms double, raw_queue_depth bigint, feature_queue_depth bigint",
}
#: Values that columns missing from old versions have.
DEFAULTS = {"connection_generation": 0, "sync_generation": 0, "accepted": True}
#: Payload columns that the replay reads as decimals.
DECIMALS = ("price", "quantity")


def raw_schema(event_type: str, version: int) -> T.StructType:
    """The schema of a raw table; an unknown type or version is an error."""
    if (event_type, version) not in PAYLOADS:
        raise KeyError(f"no schema for {event_type} version {version}")
    return T.StructType.fromDDL(f"{COMMON}, {PAYLOADS[event_type, version]}")


def latest_version(event_type: str) -> int:
    return max(v for t, v in PAYLOADS if t == event_type)


def decoded(df: DataFrame, event_type: str) -> DataFrame:
    """Decimals for prices and quantities, missing columns of older versions, mid and spread of books."""
    wanted = raw_schema(event_type, latest_version(event_type))
    for f in wanted:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(DEFAULTS.get(f.name)).cast(f.dataType))
    for c in DECIMALS:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("decimal(18,8)"))
    for side in ("bids", "asks"):
        if side in df.columns:
            df = df.withColumn(side, F.transform(side, lambda x: F.struct(x["price"].cast("decimal(18,8)").alias("price"), x["quantity"].cast("decimal(18,8)").alias("quantity"))))
    if event_type == "trusted_book":
        bid, ask = F.get("bids", F.lit(0))["price"], F.get("asks", F.lit(0))["price"]
        df = df.withColumns({"mid_price": (bid + ask) / 2, "spread": ask - bid})
        df = df.withColumn("spread_bps", F.col("spread").cast("double") / F.col("mid_price").cast("double") * 10000)
    return df


def read_raw(spark: SparkSession, paths: list[str] | str, event_type: str, version: int, symbol: str | None = None, session: str | None = None, start=None, end=None) -> DataFrame:
    """A raw table with its exact schema; the wall-clock range is closed at both ends."""
    df = spark.read.schema(raw_schema(event_type, version)).parquet(*([paths] if isinstance(paths, str) else paths))
    if symbol:
        df = df.where(F.col("symbol") == symbol.strip().upper())
    if session:
        df = df.where(F.col("capture_session_id") == session)
    if start is not None:
        df = df.where(F.col("local_time") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("local_time") <= F.lit(end))
    return df


def merged(streams: dict[str, DataFrame]) -> DataFrame:
    """All streams as one table with ``event_type`` and a struct per type, in capture order inside each series.

    Sorting is per partition: a series is never gathered for a global order.
    """
    common = [f.name for f in T.StructType.fromDDL(COMMON)]
    out = None
    for kind, df in streams.items():
        rest = [c for c in df.columns if c not in common]
        part = df.select(*common, F.lit(kind).alias("event_type"), F.struct(*rest).alias(kind))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.repartition("capture_session_id", "symbol").sortWithinPartitions("capture_session_id", "symbol", "capture_seq")




def parse_wire(df: DataFrame, payload: str = "value") -> DataFrame:
    """JSON payloads, unwrapped from ``data``, as typed columns: trades with their aggressor side, best prices, depth updates
    with their levels; unknown types are errors.

    Single trades without price or quantity are markers and are left out; aggregates keep them.
    """
    body = F.coalesce(F.get_json_object(payload, "$.data"), F.col(payload))
    at = lambda k: F.get_json_object("__b", f"$.{k}")
    out = df.withColumn("__b", body).withColumn("__e", at("e"))
    known = F.when(F.col("__e").isin("aggTrade", "trade", "bookTicker", "depthUpdate"), F.col("__e")).otherwise(F.raise_error(F.concat(F.lit("unknown event type "), F.coalesce("__e", F.lit("null")))))
    out = out.withColumns(
        {
            "kind": known,
            "symbol": F.upper(F.trim(at("s"))),
            "event_time": F.timestamp_millis(at("E").cast("bigint")),
            "trade_time": F.timestamp_millis(at("T").cast("bigint")),
            "trade_id": F.coalesce(at("a").try_cast("bigint"), at("t").try_cast("bigint")),
            "price": at("p").try_cast("decimal(18,8)"),
            "quantity": at("q").try_cast("decimal(18,8)"),
            "aggressor_side": F.when(at("m") == "true", "SELL").when(at("m") == "false", "BUY"),
            "first_update_id": at("U").cast("bigint"),
            "final_update_id": at("u").cast("bigint"),
            "previous_final_update_id": at("pu").cast("bigint"),
        }
    )
    marker = (F.col("kind") == "trade") & ~((F.col("price") > 0) & (F.col("quantity") > 0))
    ticker, depth = F.col("kind") == "bookTicker", F.col("kind") == "depthUpdate"
    number = lambda k: F.when(ticker, at(k).try_cast("decimal(18,8)"))
    pairs = lambda k: F.when(depth, F.transform(F.from_json(at(k), "array<array<string>>"), lambda x: F.struct(x[0].cast("decimal(18,8)").alias("price"), x[1].cast("decimal(18,8)").alias("quantity"))))
    out = out.withColumns({"best_bid_price": number("b"), "best_bid_quantity": number("B"), "best_ask_price": number("a"), "best_ask_quantity": number("A"), "bids": pairs("b"), "asks": pairs("a")})
    return out.where(~F.coalesce(marker, F.lit(False))).drop("__b", "__e")


def symbol_rules(info: DataFrame) -> DataFrame:
    """symbol, tick_size, step_size, min_quantity, min_notional (NULL without its filter) from a table of (symbol, status, contractType, filters).

    A symbol that isn't a trading perpetual, or has no positive tick or step or no valid least quantity, is an error.
    """
    first = lambda *kinds: F.get(F.filter("filters", lambda f: f["filterType"].isin(*kinds)), F.lit(0))
    fields = info.schema["filters"].dataType.elementType.names
    number = lambda f, name: f[name].cast("decimal(18,8)") if name in fields else F.lit(None).cast("decimal(18,8)")
    lot, notional = first("LOT_SIZE"), first("MIN_NOTIONAL", "NOTIONAL")
    need = lambda c, ok, what: F.when(F.coalesce(ok, F.lit(False)), c).otherwise(F.raise_error(F.concat(F.col("symbol"), F.lit(f": {what}"))).cast("decimal(18,8)"))
    tick, step, least = number(first("PRICE_FILTER"), "tickSize"), number(lot, "stepSize"), number(lot, "minQty")
    ok = (F.col("status") == "TRADING") & (F.col("contractType") == "PERPETUAL")
    return info.select(
        F.when(ok, F.col("symbol")).otherwise(F.raise_error(F.concat(F.lit("not a trading perpetual: "), F.col("symbol")))).alias("symbol"),
        need(tick, tick > 0, "missing filter, no positive tick size").alias("tick_size"),
        need(step, step > 0, "missing filter, no positive step size").alias("step_size"),
        need(least, least >= 0, "missing filter, no valid least quantity").alias("min_quantity"),
        F.coalesce(number(notional, "notional"), number(notional, "minNotional")).alias("min_notional"),
    )
