"""Windows of streams: sessions that merge, and sliding sums from panes in keyed state."""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.history import WINDOWS, flow_ratios
from tidemark.sources.projections import KEYS

from .keyed import with_state_store

SECOND = 1_000_000_000
#: Nanoseconds of a pane.
PANE_NS = SECOND // 10
_UNIT = 10**8


def event_time(ns: str = "monotonic_ns") -> Column:
    """The clock as event time, in microseconds."""
    return F.timestamp_micros(F.expr(f"{ns} div 1000"))


def sessions(events: DataFrame, gap_ns: int = 3 * SECOND, keys: list[str] = KEYS, late: str | None = None) -> DataFrame:
    """keys, start_ns, end_ns, first_seq, last_seq, rows of each stretch of events whose neighbours are at most ``gap_ns`` apart.

    The same for batches and, with the watermark ``late``, for streams, where a session comes out once the watermark has passed its
    end and the gap.  Gaps are measured in microseconds of the clock.
    """
    timed = events.withColumn("at", event_time())
    if late is not None:
        timed = timed.withWatermark("at", late)
    # windows that only touch are merged, so neighbours exactly a gap apart stay together
    window = F.session_window("at", f"{gap_ns // 1000} microseconds")
    out = timed.groupBy(*keys, window.alias("w")).agg(F.min("monotonic_ns").alias("start_ns"), F.max("monotonic_ns").alias("end_ns"), F.min("capture_seq").alias("first_seq"), F.max("capture_seq").alias("last_seq"), F.count(F.lit(1)).alias("rows"))
    return out.drop("w")


class Panes:
    """Trades of one series in panes of the clock: sums of each pane, and its trades for where a window cuts it."""

    def __init__(self, pane_ns: int = PANE_NS):
        self.pane_ns = pane_ns
        self.panes: dict[int, dict] = {}
        self.changed: set[int] = set()
        self.gone: set[int] = set()

    def add(self, ns: int, price: int, quantity: int, buys: bool) -> None:
        at = ns // self.pane_ns
        pane = self.panes.setdefault(at, {"sums": [0, 0, 0, 0], "trades": []})
        own = [quantity if buys else 0, 0 if buys else quantity, price * quantity, 1]
        pane["sums"] = [x + y for x, y in zip(pane["sums"], own, strict=True)]
        pane["trades"].append([ns, *own])
        self.changed.add(at)

    def total(self, since: int, until: int) -> list[int]:
        """buy, sell, notional and count of the trades in the closed window."""
        out = [0, 0, 0, 0]
        for at, pane in self.panes.items():
            if at < since // self.pane_ns or at > until // self.pane_ns:
                continue
            if since <= at * self.pane_ns and (at + 1) * self.pane_ns - 1 <= until:
                parts = [pane["sums"]]
            else:
                parts = [t[1:] for t in pane["trades"] if since <= t[0] <= until]
            for p in parts:
                out = [x + y for x, y in zip(out, p, strict=True)]
        return out

    def drop_before(self, ns: int) -> None:
        for at in [a for a in self.panes if (a + 1) * self.pane_ns <= ns]:
            del self.panes[at]
            self.changed.discard(at)
            self.gone.add(at)


class _Flow(StatefulProcessor):
    def __init__(self, windows: dict[str, int], columns: list[str], pane_ns: int):
        self.windows, self.columns, self.pane_ns = windows, columns, pane_ns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("panes", "pane bigint", "json string")
        self.last = handle.getValueState("last", "capture_seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        own = Panes(self.pane_ns)
        stored = {at: text for (at,), (text,) in self.state.iterator()}
        own.panes = {at: json.loads(text) for at, text in stored.items()}
        last, out = self.last.get()[0] if self.last.exists() else -1, []
        whole = lambda x: int(x.scaleb(8))
        for r in pd.concat(list(rows)).sort_values("capture_seq", kind="stable").itertuples():
            if r.capture_seq < last:
                raise ValueError(f"{key}: capture_seq {r.capture_seq} after {last}")
            last, ns = int(r.capture_seq), int(r.monotonic_ns)
            if r.kind == "trade":
                own.add(ns, whole(r.price), whole(r.qty), r.aggressor_side == "BUY")
                continue
            sums = []
            for size in self.windows.values():
                buy, sell, notional, n = own.total(ns - size, ns)
                sums += [Decimal(buy).scaleb(-8), Decimal(sell).scaleb(-8), Decimal(notional).scaleb(-16), n]
            out.append([*key, last, ns, *sums])
            own.drop_before(ns - max(self.windows.values()))
        for at in own.gone & stored.keys():
            self.state.removeKey((at,))
        for at in own.changed:
            self.state.updateValue((at,), (json.dumps(own.panes[at]),))
        self.last.update((last,))
        yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass


def trade_flow(stream: DataFrame, windows: dict[str, int] = WINDOWS, pane_ns: int = PANE_NS) -> DataFrame:
    """`history.trade_flow` of a stream: keys, capture_seq, monotonic_ns and the flow of each window, a row a tick.

    ``stream``: keys, capture_seq, monotonic_ns, kind (``trade`` or ``tick``), price, qty (decimal(18,8)), aggressor_side; a series in capture order
    across micro-batches (else an error), its clock not going back.  State of a series: the panes of the longest window.
    """
    with_state_store(stream.sparkSession)
    sums = [f"{p}_{n} {t}" for n in windows for p, t in (("buy", "decimal(28,8)"), ("sell", "decimal(28,8)"), ("notional", "decimal(37,16)"), ("count", "bigint"))]
    fields = [*[f"{k} string" for k in KEYS], "capture_seq bigint", "monotonic_ns bigint", *sums]
    rows = stream.select(*KEYS, "capture_seq", "monotonic_ns", "kind", "price", "qty", "aggressor_side")
    out = rows.groupBy(*KEYS).transformWithStateInPandas(_Flow(windows, [f.split()[0] for f in fields], pane_ns), ", ".join(fields), "Append", "None")
    for name in windows:
        out = out.withColumns(flow_ratios(name))
    return out
