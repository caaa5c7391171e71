"""Greedy spacing on series of any length, with or without gaps: jump maps composed over chunks.

A greedy scan keeps the first row at or after a due time and then asks for the first row a horizon later.  A chunk of
the clock acts on the scan only by taking the due time it comes with to the one it leaves with.  As a due time lies
less than a horizon after the chunk's start, this function has few steps: the rows in the first horizon, and one after.
So the steps of each chunk are worked out alone, composed inside groups of chunks, followed over the groups of a series, and
unfolded again; at last each chunk is scanned from its own due time.  What one task of a series sees is a few numbers a group.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import shared_table
from tidemark.sources.projections import KEYS

from .series import CHUNK_NS

#: Chunks of a group.
GROUP_CHUNKS = 1024
_START = np.iinfo(np.int64).min


def _leave(entries: np.ndarray, outs: np.ndarray, due: np.ndarray) -> np.ndarray:
    """The due times that a chunk with the steps (entries, outs) makes of those it gets."""
    if not len(entries):
        return due
    at = np.searchsorted(entries, due)
    return np.where(at < len(entries), outs[np.minimum(at, len(entries) - 1)], due)


def _domain(rows: np.ndarray, until: int) -> np.ndarray:
    """Rows (ascending) that can be the first at or after a due time before ``until``."""
    return np.unique(rows[: np.searchsorted(rows, until) + 1])


def chunk_steps(ns: np.ndarray, start: int, horizon_ns: int) -> tuple[np.ndarray, np.ndarray]:
    """(entries, outs): where a scan can enter the chunk's rows (ascending), and the due time it then leaves with."""
    entries = _domain(ns, start + horizon_ns)
    following = np.searchsorted(ns, ns + horizon_ns)
    at, out = np.searchsorted(ns, entries), np.zeros(len(entries), np.int64)
    going = np.arange(len(entries))
    while len(going):
        out[going] = ns[at[going]] + horizon_ns
        at[going] = following[at[going]]
        going = going[at[going] < len(ns)]
    return entries, out


def composed(steps: Iterable[tuple[np.ndarray, np.ndarray]], start: int, horizon_ns: int) -> tuple[np.ndarray, np.ndarray]:
    """The steps of consecutive chunks as those of one."""
    steps = list(steps)
    entries = _domain(np.concatenate([e for e, _ in steps]), start + horizon_ns)
    due = entries.copy()
    for own in steps:
        due = _leave(*own, due)
    return entries, due


def kept(ns: np.ndarray, due: int, horizon_ns: int) -> np.ndarray:
    """Places of the rows (ascending) that the scan keeps from a due time on."""
    out, i = [], int(np.searchsorted(ns, due))
    while i < len(ns):
        out.append(i)
        i = int(np.searchsorted(ns, ns[i] + horizon_ns))
    return np.array(out, np.int64)


def _steps(pdf: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.asarray(e, np.int64), np.asarray(o, np.int64)) for e, o in zip(pdf["entries"], pdf["outs"], strict=True)]


def non_overlapping(df: DataFrame, horizon_ns: int, keys: list[str] = KEYS, chunk_ns: int = CHUNK_NS, group_chunks: int = GROUP_CHUNKS) -> DataFrame:
    """Rows kept by a greedy scan in the order of ``monotonic_ns``: each at least ``horizon_ns`` after the last kept one, the first
    row first.  Of rows with one time the lowest ``capture_seq`` stands for all; rows without a time are never kept."""
    chunk_ns = max(chunk_ns, horizon_ns)
    names = df.columns
    cut = df.where("monotonic_ns is not null").withColumn("__chunk", F.expr(f"(monotonic_ns - pmod(monotonic_ns, {chunk_ns})) div {chunk_ns}"))
    where = ", ".join(f"{df.schema[k].simpleString().replace(':', ' ', 1)}" for k in keys)
    schema = f"{where}, __chunk bigint, entries array<bigint>, outs array<bigint>"

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        chunk = int(pdf["__chunk"].iloc[0])
        made = chunk_steps(np.sort(pdf["monotonic_ns"].to_numpy()), chunk * chunk_ns, horizon_ns)
        return pdf[[*keys, "__chunk"]].head(1).assign(entries=[made[0]], outs=[made[1]])

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__chunk")
        first = int(pdf["__chunk"].iloc[0]) // group_chunks * group_chunks
        made = composed(_steps(pdf), first * chunk_ns, horizon_ns)
        return pdf[keys].head(1).assign(__chunk=first // group_chunks, entries=[made[0]], outs=[made[1]])

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        """The due time that each row's steps get, from ``due`` (or the start of the series) on."""
        pdf = pdf.sort_values("__chunk")
        due = np.array([pdf["due"].iloc[0] if "due" in pdf else _START], np.int64)
        got = []
        for own in _steps(pdf):
            got.append(int(due[0]))
            due = _leave(*own, due)
        return pdf[[*keys, "__chunk"]].assign(due=got)

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["monotonic_ns", "capture_seq"])
        return pdf.iloc[kept(pdf["monotonic_ns"].to_numpy(), int(pdf["__due"].iloc[0]), horizon_ns)][names]

    chunks = shared_table(cut.select(*keys, "__chunk", "monotonic_ns").groupBy(*keys, "__chunk").applyInPandas(one, schema), "spacing-chunks")
    grouped = chunks.withColumn("__group", F.expr(f"(__chunk - pmod(__chunk, {group_chunks})) div {group_chunks}"))
    groups = grouped.groupBy(*keys, "__group").applyInPandas(group, schema)
    due_schema = f"{where}, __chunk bigint, due bigint"
    dues = groups.groupBy(*keys).applyInPandas(follow, due_schema).withColumnRenamed("__chunk", "__group")
    inside = grouped.join(dues, [*keys, "__group"]).groupBy(*keys, "__group").applyInPandas(follow, due_schema)
    started = cut.join(inside.withColumnRenamed("due", "__due"), [*keys, "__chunk"])
    return started.groupBy(*keys, "__chunk").applyInPandas(scan, df.schema)
