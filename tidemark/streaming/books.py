"""Stateful streaming: order-book levels and ordering checks per series, kept between micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.book import Side

from .keyed import with_state_store

OUTPUT = "symbol string, capture_seq bigint, best_bid double, best_ask double, levels bigint"


class _Top(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "capture_seq bigint")
        self.levels = handle.getMapState("levels", "side string, price double", "quantity double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else -1
        book = {"bid": Side(), "ask": Side()}
        for (side, price), (quantity,) in self.levels.iterator():
            book[side].put(price, quantity)
        changed, out = {}, []
        for r in pd.concat(list(rows)).sort_values("capture_seq").itertuples():
            if r.capture_seq <= last:
                raise ValueError(f"{key[0]}: capture_seq {r.capture_seq} after {last}")
            last = int(r.capture_seq)
            book[r.side].put(r.price, r.quantity)
            changed[r.side, r.price] = r.quantity
            bids, asks = (book[s].prices for s in ("bid", "ask"))
            out.append((key[0], last, bids[-1] if bids else None, asks[0] if asks else None, len(bids) + len(asks)))
        for level, quantity in changed.items():
            if quantity:
                self.levels.updateValue(level, (quantity,))
            else:
                self.levels.removeKey(level)
        self.last.update((last,))
        yield pd.DataFrame(out, columns=["symbol", "capture_seq", "best_bid", "best_ask", "levels"]).astype({"best_bid": float, "best_ask": float})

    def close(self) -> None:
        pass


def top_of_book(updates: DataFrame) -> DataFrame:
    """symbol, capture_seq, best_bid, best_ask, levels after each update of (symbol, capture_seq, side, price, quantity).

    Absolute quantities, 0 removes a level.  Updates must come in capture order across batches: one that
    doesn't is an error, never dropped.  A batch reads its symbols' levels and writes those it changed; prices stay sorted, so
    an update costs its own level.
    """
    with_state_store(updates.sparkSession)
    return updates.groupBy("symbol").transformWithStateInPandas(_Top(), OUTPUT, "Append", "None")
