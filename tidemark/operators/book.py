"""Order books: array expressions, top-n by last value, the sequential state, and comparison with rebuilt books."""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import prices
from tidemark.sources.projections import KEYS

from . import rebuild
from .rebuild import bridges as bridges


TIES = ["l_linenumber", "l_partkey", "l_suppkey", "quantity"]


def ladders(levels: DataFrame, book: str = "book_id", depth: int | None = None, ties: list[str] = TIES) -> DataFrame:
    """One row per book: ``bids`` and ``asks``, best first, as arrays of (price, quantity)."""
    entry = F.struct(F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price")).alias("o"), *ties, F.col("price").alias("price"), F.col("quantity").alias("q"))
    sides = levels.groupBy(book).agg(*[F.array_sort(F.collect_list(F.when(F.col("side") == s, entry))).alias(f"__{s}") for s in ("bid", "ask")])
    cut = lambda c: F.slice(c, 1, depth) if depth else F.col(c)
    return sides.select(book, *[F.transform(cut(f"__{s}"), lambda x: F.struct(x["price"].alias("price"), x["q"].alias("quantity"))).alias(f"{s}s") for s in ("bid", "ask")])


def book_features(books: DataFrame, depths: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """``books`` with best levels, mid, spread, microprice and depth volumes and imbalances."""
    bid, ask = F.get("bids", F.lit(0)), F.get("asks", F.lit(0))
    out = books.withColumns({"best_bid": bid["price"], "best_bid_quantity": bid["quantity"], "best_ask": ask["price"], "best_ask_quantity": ask["quantity"]})
    out = out.withColumns(
        {
            "mid_price": prices.mid(F.col("best_bid"), F.col("best_ask")),
            "spread": F.col("best_ask") - F.col("best_bid"),
            "spread_bps": prices.spread_bps(F.col("best_bid"), F.col("best_ask")),
            "microprice": prices.microprice(F.col("best_bid"), F.col("best_bid_quantity"), F.col("best_ask"), F.col("best_ask_quantity")),
        }
    )
    out = out.withColumn("microprice_offset_bps", (F.col("microprice") - F.col("mid_price").cast("double")) / F.col("mid_price").cast("double") * 10000)
    for n in depths:
        out = out.withColumns({f"bid_volume_l{n}": prices.depth_volume(F.col("bids"), n), f"ask_volume_l{n}": prices.depth_volume(F.col("asks"), n)})
        out = out.withColumn(f"imbalance_l{n}", prices.imbalance(F.col(f"bid_volume_l{n}"), F.col(f"ask_volume_l{n}")))
    return out


def level_violations(levels: DataFrame, book: str = "book_id") -> DataFrame:
    """Non-positive prices, negative quantities, repeated prices of a side, crossed or one-sided books."""
    bad = levels.where((F.col("price") <= 0) | (F.col("quantity") < 0)).select(book, F.when(F.col("price") <= 0, "PRICE").otherwise("QUANTITY").alias("error"))
    twice = levels.groupBy(book, "side", "price").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(book, F.lit("DUPLICATE_PRICE").alias("error"))
    best = levels.groupBy(book).agg(F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("b"), F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("a"))
    state = best.select(book, F.when(F.col("b").isNull() | F.col("a").isNull(), "EMPTY_SIDE").when(F.col("b") >= F.col("a"), "CROSSED").alias("error")).where("error is not null")
    return bad.unionByName(twice).unionByName(state)


class BookError(ValueError):
    """An update that would leave an invalid book; nothing of it is applied."""


@dataclass
class Side:
    """Levels of one side with the prices kept sorted, so an update costs its own levels."""

    quantity: dict[Decimal, Decimal] = field(default_factory=dict)
    prices: list[Decimal] = field(default_factory=list)

    def put(self, price: Decimal, quantity: Decimal) -> Decimal | None:
        """Set (or with 0 remove) a level; returns what was there."""
        old = self.quantity.get(price)
        if quantity == 0:
            if old is not None:
                del self.quantity[price]
                del self.prices[bisect_left(self.prices, price)]
        else:
            if old is None:
                insort(self.prices, price)
            self.quantity[price] = quantity
        return old


class Book:
    """Order-book state: absolute quantities, all-or-nothing updates undone by a log."""

    def __init__(self):
        self.bids, self.asks = Side(), Side()
        self.last_update_id: int | None = None
        self.cover: tuple[Decimal | None, Decimal | None] = (None, None)
        self.cover_levels = 10

    def load(self, update_id: int, bids: list[tuple[Decimal, Decimal]], asks: list[tuple[Decimal, Decimal]], limit: int | None = None) -> None:
        for side, levels in ((self.bids, bids), (self.asks, asks)):
            for p, q in levels:
                if p <= 0 or q <= 0 or p in side.quantity:
                    raise BookError(f"bad snapshot level {p} {q}")
                side.put(p, q)
        self._require_sides()
        self.last_update_id = update_id
        if limit is not None:
            self.cover = (self.bids.prices[0] if len(self.bids.prices) >= limit else None, self.asks.prices[-1] if len(self.asks.prices) >= limit else None)

    def _require_sides(self) -> None:
        if not self.bids.prices or not self.asks.prices:
            raise BookError("empty side")
        if self.bids.prices[-1] >= self.asks.prices[0]:
            raise BookError("crossed")

    def _require_cover(self) -> None:
        low, high = self.cover
        if low is not None and len(self.bids.prices) - bisect_left(self.bids.prices, low) < self.cover_levels:
            raise BookError("bids left the snapshot's range")
        if high is not None and bisect_left(self.asks.prices, high) + (high in self.asks.quantity) < self.cover_levels:
            raise BookError("asks left the snapshot's range")

    def apply(self, final_id: int, bids: list[tuple[Decimal, Decimal]], asks: list[tuple[Decimal, Decimal]]) -> None:
        undo: list[tuple[Side, Decimal, Decimal | None]] = []
        try:
            for side, levels in ((self.bids, bids), (self.asks, asks)):
                for p, q in levels:
                    if p <= 0 or q < 0:
                        raise BookError(f"bad level {p} {q}")
                    undo.append((side, p, side.put(p, q)))
            self._require_sides()
            self._require_cover()
        except BookError:
            for side, p, old in reversed(undo):
                side.put(p, old if old is not None else Decimal(0))
            raise
        self.last_update_id = final_id

    def top(self, n: int) -> tuple[list[tuple[Decimal, Decimal]], list[tuple[Decimal, Decimal]]]:
        b, a = self.bids, self.asks
        return [(p, b.quantity[p]) for p in b.prices[: -n - 1 : -1]], [(p, a.quantity[p]) for p in a.prices[:n]]


_BOOK_FIELDS = ["best_bid_price", "best_bid_quantity", "best_ask_price", "best_ask_quantity", "mid_price", "spread", "spread_bps"]


def _derived(bids: Column, asks: Column) -> dict[str, Column]:
    """The recorded book's fields from its levels."""
    bid, ask = F.get(bids, F.lit(0)), F.get(asks, F.lit(0))
    made = [bid["price"], bid["quantity"], ask["price"], ask["quantity"], prices.mid(bid["price"], ask["price"]), ask["price"] - bid["price"], prices.spread_bps(bid["price"], ask["price"])]
    return dict(zip(_BOOK_FIELDS, made, strict=True))


def compare(recorded: DataFrame, made: DataFrame) -> DataFrame:
    """Recorded books (rows of kind ``trusted``, others are left out) against rebuilt ones (``books`` of `rebuild.rebuild`).

    Recorded rows may also have any of best_bid_price, best_bid_quantity, best_ask_price, best_ask_quantity, mid_price,
    spread, spread_bps.  One row per recorded book: capture_seq, ok, error (the fields that differ, or why there is no
    book), gaps so far in the series.
    """
    both = recorded.where("kind = 'trusted'").join(made, [*KEYS, "capture_seq"])
    differs = {"last_update_id": ("made_id", "final_id"), "bids": ("made_bids", "bids"), "asks": ("made_asks", "asks")}
    tests = [F.when(~F.col(a).eqNullSafe(F.col(b)), F.lit(name)) for name, (a, b) in differs.items()]
    tests += [F.when(~v.cast("double").eqNullSafe(F.col(n).cast("double")), F.lit(n)) for n, v in _derived(F.col("made_bids"), F.col("made_asks")).items() if n in recorded.columns]
    error = F.coalesce("reason", F.nullif(F.array_join(F.array_compact(F.array(*tests)), ", "), F.lit("")))
    return both.select(*KEYS, "capture_seq", error.alias("error"), "gaps").select(*KEYS, "capture_seq", F.col("error").isNull().alias("ok"), "error", "gaps")


def reconstruct(events: DataFrame, chunk_rows: int = rebuild.CHUNK_ROWS) -> DataFrame:
    """Rebuild books from a tagged event stream (see `rebuild.rebuild`) and `compare` them with the recorded ones.

    A stream with faults of its own is reported by `reconstruction_faults`.
    """
    return compare(events, rebuild.rebuild(events, chunk_rows).books)


def reconstruction_faults(events: DataFrame, chunk_rows: int = rebuild.CHUNK_ROWS) -> DataFrame:
    """keys, capture_seq, reason, fatal: where each generation's book ends, whether or not a recorded book follows.
    ``fatal`` rows (a missing buffered update, a bootstrap that isn't a book) make the whole stream unfit."""
    return rebuild.rebuild(events, chunk_rows).faults


def last_levels(updates: DataFrame, keys: list[str], depth: int = 5) -> DataFrame:
    """The best levels after all updates: the last quantity of each price, zero quantities removed.

    ``updates``: keys, side, price, quantity, capture_seq.  An absolute-quantity fold without validation is a last
    value per price, so this needs no sequential pass.
    """
    last = updates.groupBy(*keys, "side", "price").agg(F.max_by("quantity", "capture_seq").alias("quantity")).where("quantity > 0")
    order = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    w = Window.partitionBy(*keys, "side").orderBy(order)
    return last.withColumn("level", F.row_number().over(w)).where(F.col("level") <= depth)
