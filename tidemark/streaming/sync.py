"""Synchronisation of order books as a keyed stream: snapshots, bridges, gaps, stale books, overflow.

A symbol's machine gets its rows in capture order: ``connected``, ``disconnected``, ``depth``, ``snapshot`` and
``snapshot_failed``.  Each row gives one row of what the machine is in after it; ``wants_snapshot`` says that a
snapshot has to be fetched (what fetches it is outside).  A synced book without an update for ``stale_ns`` gives one ``STALE`` row
at that time, by a timer on the watermark or, if that comes first, with the next row.

State by symbol: the machine's scalars, the book's levels (a map, of which only changed levels are written), the
updates that wait for a bridge (a list of at most ``max_buffered``) and the last 4,096 applied updates (`keyed.Recent`).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.book import Book, BookError

from .keyed import RECENT, Recent, long_levels, with_state_store

MAX_BUFFERED = 50_000
STALE_NS = 3_000_000_000
OUTPUT = (
    "symbol string, capture_seq bigint, monotonic_ns bigint, state string, reason string, wants_snapshot boolean, last_update_id bigint, best_bid bigint, best_ask bigint, buffered bigint, "
    "resyncs bigint, synced bigint, failures bigint, gaps bigint, overflows bigint, crossed bigint, applied bigint, discarded bigint, late bigint"
)
COUNTERS = ["resyncs", "synced", "failures", "gaps", "overflows", "crossed", "applied", "discarded", "late"]


class SyncError(BookError):
    """An update that doesn't continue what came before; ``kind``: bridge, gap or stale."""

    def __init__(self, kind: str, text: str):
        super().__init__(text)
        self.kind = kind


@dataclass(frozen=True)
class Update:
    first_id: int
    final_id: int
    previous_id: int | None
    ns: int
    bids: tuple[tuple[int, int], ...]
    asks: tuple[tuple[int, int], ...]

    @property
    def key(self) -> str:
        return json.dumps([self.first_id, self.final_id, self.previous_id, self.bids, self.asks])

    @staticmethod
    def of(text: str) -> Update:
        x = json.loads(text)
        return Update(*x[:4], *(tuple(map(tuple, side)) for side in x[4:]))

    def text(self) -> str:
        return json.dumps([self.first_id, self.final_id, self.previous_id, self.ns, self.bids, self.asks])


@dataclass
class Scalars:
    """What a machine is in.  ``anchor``: the id of a loaded snapshot that no update has bridged yet."""

    state: str = "EMPTY"
    reason: str | None = None
    connected: bool = False
    ever_connected: bool = False
    anchor: int | None = None
    last_id: int | None = None
    last_ns: int | None = None
    last_seq: int = -1
    low: int | None = None
    high: int | None = None
    timer_ms: int | None = None
    resyncs: int = 0
    synced: int = 0
    failures: int = 0
    gaps: int = 0
    overflows: int = 0
    crossed: int = 0
    applied: int = 0
    discarded: int = 0
    late: int = 0


class Machine:
    """One symbol.  ``recent`` needs ``in``, ``add`` and ``clear``."""

    def __init__(self, recent, scalars: Scalars | None = None, book: Book | None = None, buffer: list[Update] | None = None, max_buffered: int = MAX_BUFFERED, stale_ns: int = STALE_NS):
        self.s, self.book, self.buffer, self.recent = scalars or Scalars(), book or Book(), buffer or [], recent
        self.max_buffered, self.stale_ns = max_buffered, stale_ns
        self.wants = False

    def stale_at(self) -> int | None:
        return self.s.last_ns + self.stale_ns if self.s.state == "SYNCED" else None

    def go_stale(self) -> None:
        self.s.state = "STALE"

    def accept(self, kind: str, seq: int, ns: int, row) -> None:
        s = self.s
        self.wants = False
        if seq <= s.last_seq:
            s.late += 1
            return
        s.last_seq = seq
        if kind == "connected":
            self._begin("reconnect" if s.ever_connected else "first connection", again=s.ever_connected)
            s.connected = s.ever_connected = True
        elif kind == "disconnected":
            s.connected = False
            self._forget("DESYNCED", "disconnected")
            self.buffer.clear()
        elif kind == "depth":
            self._depth(Update(row.first_id, row.final_id, row.previous_id, ns, *(tuple((p, q) for p, q in side) for side in (row.bids, row.asks))))
        elif s.connected and s.state in ("BUFFERING", "RESYNCING"):
            if kind == "snapshot":
                self._snapshot(row)
            else:
                self._failed(BookError("snapshot request failed"))
                s.state, self.wants = "RESYNCING", True

    def _forget(self, state: str, reason: str) -> None:
        self.s.state, self.s.reason, self.s.anchor, self.s.last_id, self.s.last_ns = state, reason, None, None, None
        self.book = Book()

    def _begin(self, reason: str, again: bool, buffer: list[Update] | None = None) -> None:
        self._forget("RESYNCING" if again else "BUFFERING", reason)
        self.s.resyncs += again
        self.buffer[:] = buffer or []
        self.recent.clear()
        self.wants = True

    def _failed(self, error: BookError) -> None:
        self.s.failures += 1
        self.s.reason = str(error)
        self.s.gaps += getattr(error, "kind", "") == "gap"
        self.s.crossed += str(error) == "crossed"

    def _depth(self, u: Update) -> None:
        s = self.s
        if not s.connected:
            return
        if s.state in ("SYNCED", "STALE"):
            self._live(u)
        elif len(self.buffer) >= self.max_buffered:
            s.overflows += 1
            s.failures += 1
            self._begin(f"more than {self.max_buffered} updates wait for a snapshot", True, [u])
        else:
            self.buffer.append(u)
            if s.anchor is not None:
                try:
                    self._promote()
                except BookError as error:
                    self._failed(error)
                    self._begin(str(error), True, list(self.buffer) if getattr(error, "kind", "") == "bridge" else [])

    def _snapshot(self, row) -> None:
        self.book = Book()
        try:
            self.book.load(row.final_id, [tuple(x) for x in row.bids], [tuple(x) for x in row.asks], row.snapshot_limit)
            self.s.anchor, self.s.state = row.final_id, "SYNCING"
            self._promote()
        except BookError as error:
            self._failed(error)
            self._forget("RESYNCING", str(error))
            self.wants = True

    def _promote(self) -> None:
        """Play the waiting updates on the snapshot, from the one that bridges it."""
        s, anchor = self.s, self.s.anchor
        old = next((i for i, u in enumerate(self.buffer) if u.final_id >= anchor), len(self.buffer))
        s.discarded += old
        del self.buffer[:old]
        if not self.buffer:
            return
        first = self.buffer[0]
        if not first.first_id <= anchor <= first.final_id:
            raise SyncError("bridge", f"no bridge: {first.first_id} to {first.final_id} from snapshot {anchor}")
        played: dict[str, Update] = {}
        last = None
        for u in self.buffer:
            if u.key in played:
                s.discarded += 1
                continue
            if last is not None:
                self._require_next(u, last)
            self.book.apply(u.final_id, list(u.bids), list(u.asks))
            played[u.key], last = u, u.final_id
        self.buffer.clear()
        self.recent.clear()
        for key in list(played)[-RECENT:]:
            self.recent.add(key)
        s.applied += len(played)
        s.synced += 1
        s.state, s.anchor, s.last_id, s.last_ns = "SYNCED", None, last, u.ns

    @staticmethod
    def _require_next(u: Update, last: int) -> None:
        if u.final_id <= last:
            raise SyncError("stale", f"update {u.final_id} after {last}")
        if u.previous_id != last:
            raise SyncError("gap", f"gap: update after {u.previous_id}, not after {last}")

    def _live(self, u: Update) -> None:
        s = self.s
        if u.key in self.recent:
            s.discarded += 1
            return
        try:
            self._require_next(u, s.last_id)
            self.book.apply(u.final_id, list(u.bids), list(u.asks))
        except BookError as error:
            self._failed(error)
            self._begin(str(error), True, [u])
            return
        self.recent.add(u.key)
        s.applied += 1
        s.state, s.last_id, s.last_ns = "SYNCED", u.final_id, u.ns

    def report(self, symbol: str, seq: int, ns: int) -> tuple:
        trusted = self.s.state == "SYNCED"
        best = (self.book.bids.prices[-1], self.book.asks.prices[0]) if trusted else (None, None)
        s = self.s
        return (symbol, seq, ns, s.state, s.reason, self.wants, s.last_id if trusted else None, *best, len(self.buffer), *(getattr(s, c) for c in COUNTERS))


def run_rows(machine: Machine, symbol: str, rows: pd.DataFrame) -> list[tuple]:
    """What the machine reports for rows in capture order, and a row where the book has gone stale in between."""
    out = []
    for r in rows.sort_values("capture_seq", kind="stable").itertuples():
        due = machine.stale_at()
        if due is not None and r.monotonic_ns > due and r.capture_seq > machine.s.last_seq:
            out.append(_stale(machine, symbol, due))
        machine.accept(r.kind, int(r.capture_seq), int(r.monotonic_ns), _Row(r))
        out.append(machine.report(symbol, int(r.capture_seq), int(r.monotonic_ns)))
    return out


def _stale(machine: Machine, symbol: str, at: int) -> tuple:
    machine.go_stale()
    machine.wants = False
    return machine.report(symbol, machine.s.last_seq, at)


class _Row:
    """A row's fields as Python integers; levels as pairs."""

    def __init__(self, r):
        whole = lambda x: None if x is None or x != x else int(x)
        self.first_id, self.final_id, self.previous_id, self.snapshot_limit = (whole(getattr(r, c)) for c in ("first_id", "final_id", "previous_id", "snapshot_limit"))
        pairs = lambda x: [] if x is None or isinstance(x, float) else [(int(e["price"]), int(e["quantity"])) for e in x]
        self.bids, self.asks = pairs(r.bids), pairs(r.asks)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in OUTPUT.split(", ")]
    whole = {n: "Int64" for n, c in zip(names, OUTPUT.split(", "), strict=True) if c.endswith("bigint")}
    return pd.DataFrame(rows, columns=names).astype(whole)


class _Synchroniser(StatefulProcessor):
    def __init__(self, max_buffered: int, stale_ns: int):
        self.max_buffered, self.stale_ns = max_buffered, stale_ns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.scalars = handle.getValueState("scalars", "json string")
        self.levels = handle.getMapState("levels", "side string, price bigint", "quantity bigint")
        self.waiting = handle.getListState("waiting", "update string")
        self.recent = Recent(handle)

    def _load(self) -> Machine:
        s = Scalars(**json.loads(self.scalars.get()[0])) if self.scalars.exists() else Scalars()
        book = Book()
        for (side, price), (quantity,) in self.levels.iterator():
            (book.bids if side == "bid" else book.asks).put(price, quantity)
        book.last_update_id, book.cover = s.last_id, (s.low, s.high)
        self.before = {("bid", p): q for p, q in book.bids.quantity.items()} | {("ask", p): q for p, q in book.asks.quantity.items()}
        buffer = [Update.of(x) for (x,) in self.waiting.get()] if self.waiting.exists() else []
        self.held = [u.text() for u in buffer]
        self.recent.load()
        return Machine(self.recent, s, book, buffer, self.max_buffered, self.stale_ns)

    def _save(self, m: Machine) -> None:
        """Only what has changed is written."""
        now = {("bid", p): q for p, q in m.book.bids.quantity.items()} | {("ask", p): q for p, q in m.book.asks.quantity.items()}
        for key in self.before.keys() - now.keys():
            self.levels.removeKey(key)
        for key, q in now.items():
            if self.before.get(key) != q:
                self.levels.updateValue(key, (q,))
        texts = [u.text() for u in m.buffer]
        if texts[: len(self.held)] == self.held:
            if texts[len(self.held) :]:
                self.waiting.appendList([(t,) for t in texts[len(self.held) :]])
        elif texts:
            self.waiting.put([(t,) for t in texts])
        else:
            self.waiting.clear()
        due = m.stale_at()
        timer = None if due is None else due // 1_000_000 + 1
        if timer != m.s.timer_ms:
            if m.s.timer_ms is not None:
                self.handle.deleteTimer(m.s.timer_ms)
            if timer is not None:
                self.handle.registerTimer(timer)
            m.s.timer_ms = timer
        m.s.low, m.s.high = m.book.cover
        self.scalars.update((json.dumps(asdict(m.s)),))
        self.recent.save()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        m = self._load()
        out = run_rows(m, key[0], pd.concat(list(rows)))
        self._save(m)
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        m = self._load()
        m.s.timer_ms = None
        due = m.stale_at()
        out = [_stale(m, key[0], due)] if due is not None and due // 1_000_000 + 1 <= expiredTimerInfo.getExpiryTimeInMs() else []
        self._save(m)
        yield _frame(out)

    def close(self) -> None:
        pass


def synchronise(stream: DataFrame, late: str = "0 seconds", max_buffered: int = MAX_BUFFERED, stale_ns: int = STALE_NS) -> DataFrame:
    """See the module.  ``stream``: symbol, capture_seq, monotonic_ns, kind, first_id, final_id, previous_id, bids, asks (arrays of (price, quantity)),
    snapshot_limit.  Rows of a symbol come in capture order across micro-batches; one that doesn't is counted as ``late`` and
    changes nothing.  Best prices are in units of 1e-8."""
    with_state_store(stream.sparkSession)
    rows = stream.select("symbol", "capture_seq", "monotonic_ns", "kind", "first_id", "final_id", "previous_id", "snapshot_limit", *[long_levels(c).alias(c) for c in ("bids", "asks")], F.timestamp_micros(F.expr("monotonic_ns div 1000")).alias("at"))
    return rows.withWatermark("at", late).groupBy("symbol").transformWithStateInPandas(_Synchroniser(max_buffered, stale_ns), OUTPUT, "Append", "EventTime")
