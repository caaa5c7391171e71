"""Features at ticks: the latest book, its age and health, returns and volatility of its history, and trade flow.

Everything a tick sees was captured before it.  A history of mids belongs to an epoch: it starts anew where the book is
invalidated, the stream is lost, a book says another resynchronisation, or isn't healthy.  Trade flow starts anew where the
stream is lost.  Latest values reach back without bound, in two levels (inside pieces of a series, then over the pieces); frames
are bounded and run per chunk of the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import prices
from tidemark.sources.projections import KEYS

from . import history
from .series import SECOND, at_home, chunk_window, chunked, last_before, last_before_each, running_sum, upto

BOOK = ["best_bid_price", "best_bid_quantity", "best_ask_price", "best_ask_quantity", "resync_count", "healthy", "receive_ns", "book_age_ms", "update_id"]
BOOK_STALE_MS, TRADE_STALE_MS = 3_000, 5_000
#: A history forgets mids that are this much older than its latest one.
RETENTION_NS = 15 * SECOND


def states(events: DataFrame) -> DataFrame:
    """``events`` with what holds before each row: ``book`` (struct, with ``at``), ``book_valid``, ``connected``,
    ``active_ns`` (-1 if the stream is lost); and the numbers of its ``epoch`` and ``connection``."""
    kind = F.col("kind")
    is_book = kind == "book"
    rows = last_before(events, F.when(is_book, F.col("resync_count")), "__generation")
    new = kind.isin("disconnected", "invalidated") | (is_book & ~F.coalesce((F.col("__generation") == F.col("resync_count")) & F.col("healthy"), F.lit(False)))
    rows = running_sum(rows, new.cast("long"), "epoch")
    rows = running_sum(rows, (kind == "disconnected").cast("long"), "connection")
    held = {
        "book": F.when(is_book, F.struct(F.col("monotonic_ns").alias("at"), *BOOK)),
        "book_valid": F.when(is_book, F.col("healthy")).when(kind.isin("disconnected", "invalidated"), F.lit(False)),
        "connected": F.when(kind == "connected", F.lit(True)).when(kind == "disconnected", F.lit(False)),
        "active_ns": F.when(kind.isin("connected", "trade", "activity"), F.col("monotonic_ns")).when(kind == "disconnected", F.lit(-1).cast("long")),
    }
    return last_before_each(rows, held).drop("__generation")


def mid_history(rows: DataFrame, horizons: dict[str, int], windows: dict[str, int], keys: list[str]) -> DataFrame:
    """The ticks of ``rows`` (keys, capture_seq, monotonic_ns, tick, mid) with returns and volatilities of the mids before them.

    A return is ln of the latest mid over the latest one at or before the horizon ago, if the history still has that; a volatility
    the root of the summed squared log returns between the mids of the window, NULL below two.  Of several mids of an
    instant the last one counts.
    """
    seen = last_before_each(rows, {"__now": F.when(~F.col("tick"), F.col("mid")), "__now_ns": F.when(~F.col("tick"), F.col("monotonic_ns"))}, keys)
    reach = RETENTION_NS + max(horizons.values())
    cut = chunked(seen, max(reach, 2 * max(windows.values())), 0)
    back = Window.partitionBy(*keys, "chunk").orderBy(F.col("monotonic_ns").desc(), F.col("capture_seq").desc())
    later = F.last(F.when(~F.col("tick"), F.col("monotonic_ns")), ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    cut = cut.withColumn("__last", F.when(~F.col("tick") & ~later.eqNullSafe(F.col("monotonic_ns")), F.struct("mid", "monotonic_ns")))
    # the last mid of an earlier instant: ranges end a nanosecond before the row
    w = chunk_window(keys)
    before = F.last("__last", ignorenulls=True).over(upto(w, -1))
    before = F.when(before["monotonic_ns"] >= F.col("monotonic_ns") - 2 * max(windows.values()), before)
    square = lambda now, old: F.coalesce(F.pow(F.log(now / old), F.lit(2.0)), F.lit(0.0)).cast("decimal(32,28)")
    cut = cut.withColumn("__before", before).withColumn("__square", F.when(F.col("__last").isNotNull(), square(F.col("mid"), F.col("__before.mid"))))
    cut = cut.withColumn("__own", history.seen("__square"))
    cols: dict[str, Column] = {}
    for name, h in horizons.items():
        old = F.last("__last", ignorenulls=True).over(upto(w, -h))
        kept = old["monotonic_ns"] >= F.col("__now_ns") - RETENTION_NS
        unchanged = F.col("monotonic_ns") - h >= F.col("__now_ns")
        cols[f"return_{name}"] = F.when(unchanged, F.lit(0.0)).when(kept, F.log(F.col("__now") / old["mid"]))
    at_tick = F.coalesce(F.col("__now_ns") == F.col("monotonic_ns"), F.lit(False))
    own = F.when(at_tick, square(F.col("__now"), F.col("__before.mid"))).otherwise(F.lit(0).cast("decimal(32,28)"))
    for name, size in windows.items():
        total = history.reach_squares(size, keys) + own
        count = F.count("__square").over(upto(w, -1)) - F.count("__square").over(upto(w, -size - 1))
        cols[f"realized_volatility_{name}"] = F.when(count + at_tick.cast("int") >= 2, F.sqrt(total.cast("double")))
    return at_home(cut.withColumns(cols).where("tick").drop("__now", "__now_ns", "__last", "__before", "__square", "__own"))


def feature_engine(events: DataFrame, book_stale_ms: int = BOOK_STALE_MS, trade_stale_ms: int = TRADE_STALE_MS) -> DataFrame:
    """Features at each tick that has a book before it.

    ``events``: keys, capture_seq (no ties in a series), monotonic_ns (not going back along it), kind (connected,
    disconnected, invalidated, book, trade, activity, tick); of books ``BOOK`` (a book's receive_ns, where it has one, isn't before the row
    captured before it); of trades price, qty, aggressor_side.
    """
    rows = states(events)
    ticks = rows.where("kind = 'tick' and book is not null")
    at = F.col("monotonic_ns")
    mid = prices.mid(F.col("best_bid_price"), F.col("best_ask_price")).cast("double")
    base = [*KEYS, "epoch", "capture_seq"]
    observed = rows.where("kind = 'book' and healthy").select(*base, F.coalesce("receive_ns", "monotonic_ns").alias("monotonic_ns"), F.lit(False).alias("tick"), mid.alias("mid"))
    asked = ticks.select(*base, "monotonic_ns", F.lit(True).alias("tick"), F.lit(None).cast("double").alias("mid"))
    past = mid_history(observed.unionByName(asked), history.RETURN_HORIZONS, history.WINDOWS, [*KEYS, "epoch"])
    flow_keys = [*KEYS, "connection"]
    flow = history.trade_flow(ticks.select(*flow_keys, "capture_seq", "monotonic_ns"), rows.where("kind = 'trade'").select(*flow_keys, "capture_seq", "monotonic_ns", "price", "qty", "aggressor_side"), keys=flow_keys)
    flows = [c for c in flow.columns if c not in (*flow_keys, "capture_seq", "monotonic_ns")]
    out = ticks.join(past.drop("tick", "mid", "epoch", "monotonic_ns"), [*KEYS, "capture_seq"]).join(flow.drop("connection", "monotonic_ns"), [*KEYS, "capture_seq"])
    ms = lambda since: F.greatest(F.lit(0.0), (at - since) / F.lit(1e6))
    reported = F.col("book.book_age_ms") + ms(F.col("book.at"))
    age = F.greatest(reported, F.coalesce(ms(F.col("book.receive_ns")), reported))
    idle = F.when(F.col("active_ns") >= 0, ms(F.col("active_ns")))
    valid, streams = F.coalesce("book_valid", F.lit(False)), F.coalesce(F.col("connected") & (idle <= trade_stale_ms), F.lit(False))
    b = {c: F.col(f"book.{c}") for c in BOOK}
    reasons = prices.invalid_reasons(
        BOOK_UNHEALTHY=~valid, BOOK_STALE=age > book_stale_ms, INVALID_SPREAD=b["best_bid_price"] >= b["best_ask_price"],
        INVALID_TOP_OF_BOOK=(b["best_bid_quantity"] <= 0) | (b["best_ask_quantity"] <= 0), TRADE_STREAM_UNHEALTHY=~streams,
    )
    names = [*[f"return_{h}" for h in history.RETURN_HORIZONS], *[f"realized_volatility_{w}" for w in history.WINDOWS]]
    return out.select(
        *KEYS, "capture_seq", "monotonic_ns", b["update_id"].alias("book_last_update_id"), *[b[c].alias(c) for c in BOOK[:4]],
        prices.mid(b["best_bid_price"], b["best_ask_price"]).alias("mid_price"), prices.spread_bps(b["best_bid_price"], b["best_ask_price"]).alias("spread_bps"), *names,
        *[F.when(streams, F.col(c)).alias(c) for c in flows], age.alias("book_age_ms"), idle.alias("trade_stream_age_ms"), (valid & (age <= book_stale_ms)).alias("book_healthy"),
        streams.alias("trade_stream_healthy"), (F.size(reasons) == 0).alias("feature_valid"), reasons.alias("invalid_reasons"),
    )
