"""Keyed state that outlives micro-batches: a ring of recent ids, and exact deduplication of bounded reach with it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Ids that are remembered by key.
RECENT = 4096
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession) -> SparkSession:
    """The session with the state store that stateful processors need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return spark


class Recent:
    """The last ``capacity`` different ids in order of their first arrival; an id that was there keeps its place.

    Two maps, id to place and place to id, so that adding one touches two entries however many are held.
    """

    def __init__(self, handle: StatefulProcessorHandle, capacity: int = RECENT):
        self.capacity = capacity
        self.places = handle.getMapState("recent_places", "id string", "place bigint")
        self.ids = handle.getMapState("recent_ids", "place bigint", "id string")
        self.ends = handle.getValueState("recent_ends", "first bigint, next bigint")

    def load(self) -> None:
        self.first, self.next = self.ends.get() if self.ends.exists() else (0, 0)

    def save(self) -> None:
        self.ends.update((self.first, self.next))

    def __contains__(self, key: str) -> bool:
        return self.places.containsKey((key,))

    def add(self, key: str) -> None:
        if key in self:
            return
        if self.next - self.first == self.capacity:
            self.places.removeKey((self.ids.getValue((self.first,))[0],))
            self.ids.removeKey((self.first,))
            self.first += 1
        self.places.updateValue((key,), (self.next,))
        self.ids.updateValue((self.next,), (key,))
        self.next += 1

    def clear(self) -> None:
        self.places.clear()
        self.ids.clear()
        self.first = self.next = 0


class _First(StatefulProcessor):
    def __init__(self, key: str, id_col: str, order: str, capacity: int):
        self.key, self.id_col, self.order, self.capacity = key, id_col, order, capacity

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = Recent(handle, self.capacity)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.recent.load()
        pdf = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        fresh = []
        for i in pdf[self.id_col].astype(str).tolist():
            fresh.append(i not in self.recent)
            if fresh[-1]:
                self.recent.add(i)
        self.recent.save()
        yield pdf[fresh]

    def close(self) -> None:
        pass


def first_of_recent(stream: DataFrame, key: str, id_col: str, order: str = "capture_seq", capacity: int = RECENT) -> DataFrame:
    """The rows of a stream whose id isn't among the last ``capacity`` different ids of their key.

    Exact within that reach: what leaves is the id that arrived first, so a repeat passes only if at least
    ``capacity`` different ids of its key came in between.  Rows of a micro-batch count in ``order``.  A null id is an id like any other.
    """
    with_state_store(stream.sparkSession)
    return stream.groupBy(key).transformWithStateInPandas(_First(key, id_col, order, capacity), stream.schema, "Append", "None")


def first_within(stream: DataFrame, key: str, id_col: str, time: str, reach: str) -> DataFrame:
    """The first row of each (key, id) in ``reach`` of event time; the watermark lets go of older ids."""
    return stream.withWatermark(time, reach).dropDuplicatesWithinWatermark([key, id_col])


def long_levels(levels: str) -> F.Column:
    """An array of (price, quantity) in units of 1e-8, as longs."""
    unit = lambda c: (c * 100_000_000).cast("bigint")
    return F.transform(levels, lambda x: F.struct(unit(x["price"]).alias("price"), unit(x["quantity"]).alias("quantity")))
