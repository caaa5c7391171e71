"""Prefix tries of conversations, in level order (LOUDS), with rollups.

Conversations are lists of turn labels (two 64-bit hashes of role and text, and the text's code points); texts
aren't moved.  Equal lists are one path; the ids that end on it are listed by blocks of their range and hashed as one sorted stream.  Paths are sorted
and dealt by range, so a shard holds the paths between two prefixes however many share a first turn.  In a shard
numpy builds the trie in level order: a bit vector with one 1 a child and a closing 0 a node, and an array of labels.
Rollups go through the levels from the lowest to the root.

Only the prefixes of a shard's first and last path can stand in other shards too.  These upper nodes (two paths a
shard, so their number follows the shards and the longest conversation, never the conversations) are
summed up by prefix, and one task rolls them up over the sums of what hangs below them.

Defined cases: rows without a conversation id belong to no conversation; null roles and texts are empty; turns are ordered
by turn (null first), those of one number by role and text; repeated rows are turns of their own; a table without
conversations has no node; other columns aren't read; texts of any length are hashed whole.  A conversation's labels (20 bytes a
turn) are one row, and that row must fit a task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Scratch, quoted, read_table

#: Turns of a shard, about.
SHARD_TURNS = 1 << 18
#: Turns that op11's conversations take over at most.
SHARED_TURNS = 5
#: Ids that share all but so many low bits are listed together.
BLOCK_BITS = 16
NO_MEMBER = hashlib.sha256(b"").hexdigest()
ROOT_KEY = bytes(16)
_NODE = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("parent_key", T.BinaryType())]
    + [T.StructField(n, T.LongType()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [T.StructField("ends_sha256", T.StringType()), T.StructField("weight", T.LongType())]
)
NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_lists(df: DataFrame, scratch: Scratch, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, path): each conversation's turns in order, as structs of two hashes and the code points."""
    empty = lambda c: F.coalesce(quoted(c).cast("string"), F.lit(""))
    rows = df.where(quoted(conv).isNotNull()).select(quoted(conv).cast("long").alias("conv_id"), quoted(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    label = [F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"), F.char_length("text").cast("long").alias("weight")]
    listed = lambda df, order: df.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*order, *label))).alias("turns"))
    path = F.transform("turns", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["weight"].alias("weight"))).alias("path")
    lists = scratch.table(listed(rows, ["turn"]))
    repeats = F.size(F.array_distinct(F.transform("turns", lambda x: x["turn"]))) < F.size("turns")
    tied = scratch.table(lists.where(repeats).select("conv_id"))
    if tied.isEmpty():
        return lists.select("conv_id", path)
    # only where turns have the same number are texts needed for their order
    again = listed(rows.join(tied, "conv_id", "left_semi"), ["turn", "role", "text"])
    return lists.where(~repeats).select("conv_id", path).unionByName(again.select("conv_id", path))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (k1, k2, ids) sorted by key and ids: each key's first id, number of ids and digest of all, as a stream."""
    key, first, n, digest = None, 0, 0, None
    out: list[tuple[int, int, str]] = []
    made = lambda: pa.RecordBatch.from_pydict(dict(zip(("conv_id", "n", "ends"), map(list, zip(*out)))), schema=pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())]))
    for b in batches:
        if not b.num_rows:
            continue
        k1, k2 = (b.column(i).to_numpy() for i in range(2))
        at, ids = np.asarray(b.column(2).offsets), b.column(2).values.to_numpy()
        starts = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))).tolist()
        for i, j in zip(starts, [*starts[1:], len(k1)]):
            own = ids[at[i] : at[j]].tolist()
            text = ",".join(map(str, own)).encode()
            if key == (k1[i], k2[i]):
                digest.update(b"," + text)
                n += len(own)
                continue
            if key is not None:
                out.append((first, n, digest.hexdigest()))
            key, first, n, digest = (k1[i], k2[i]), own[0], len(own), hashlib.sha256(text)
        if out:
            yield made()
            out.clear()
    if key is not None:
        out.append((first, n, digest.hexdigest()))
        yield made()


def distinct_paths(lists: DataFrame) -> DataFrame:
    """(conv_id, path, n, ends): each different path with its smallest id, number of ids and the digest of all ids."""
    keyed = lists.select(F.xxhash64(F.lit(1), "path").alias("k1"), F.xxhash64(F.lit(2), "path").alias("k2"), F.shiftright("conv_id", BLOCK_BITS).alias("block"), "conv_id")
    # ids of a path meet by blocks of their range first, so that a path of very many ids comes as a few sorted lists
    blocks = keyed.groupBy("k1", "k2", "block").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    ends = blocks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "block").select("k1", "k2", "ids").mapInArrow(_groups, "conv_id long, n long, ends string")
    return lists.join(ends, "conv_id")


@dataclass
class Louds:
    """A trie in level order: node 0 is the root; ``bits`` has for each node a 1 for each child and then a 0."""

    bits: np.ndarray
    #: label of each node but the root: rows of (h1, h2)
    labels: np.ndarray

    @classmethod
    def of(cls, parents: np.ndarray, labels: np.ndarray) -> Louds:
        """From the parents of the nodes 1, 2, ... in level order."""
        degree = np.bincount(parents, minlength=len(parents) + 1)
        bits = np.ones(int(degree.sum()) + len(degree), bool)
        bits[np.cumsum(degree + 1) - 1] = False
        return cls(bits, labels)

    def parents(self) -> np.ndarray:
        """Parents of the nodes 1, 2, ...: the k-th 1 belongs to the node as many 0 stand before it."""
        ones = np.flatnonzero(self.bits)
        return ones - np.arange(len(ones))

    def degrees(self) -> np.ndarray:
        """Children of each node: the 1s between two 0s."""
        return np.diff(np.flatnonzero(~self.bits), prepend=-1) - 1

    def levels(self) -> list[slice]:
        """Nodes of each depth from 1 on."""
        out, lo, hi, ends = [], 0, 1, np.cumsum(self.degrees()) + 1
        while lo < hi:
            lo, hi = hi, int(ends[hi - 1])
            if lo < hi:
                out.append(slice(lo, hi))
        return out


def common_prefixes(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each path (rows ``at[i]:at[i+1]`` of ``h``) how many first labels it shares with the one before it."""
    size = np.diff(at)
    out = np.zeros(len(size), np.int64)
    most = np.minimum(size[1:], size[:-1])
    some = np.flatnonzero(most)
    if len(some):
        n = most[some]
        first = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(first, n)
        same = (h[np.repeat(at[some], n) + step] == h[np.repeat(at[some + 1], n) + step]).all(axis=1)
        out[some + 1] = np.minimum.reduceat(np.where(same, np.repeat(n, n), step), first)
    return out


def build(h: np.ndarray, at: np.ndarray) -> tuple[Louds, np.ndarray, np.ndarray, np.ndarray]:
    """(trie, depth of each node, path node ``last[i]`` where path i ends, row of ``h`` of each node but the root) of
    different paths in lexicographic order."""
    shared, size = common_prefixes(h, at), np.diff(at)
    new = size - shared
    first = np.cumsum(new) - new
    total = int(new.sum())
    # nodes as paths meet them, the parent before its children
    depth = np.arange(total) - np.repeat(first, new) + np.repeat(shared, new) + 1
    row = np.repeat(at[:-1], new) + depth - 1
    order = np.argsort(depth, kind="stable")
    key = depth[order] * (total + 1) + order
    met, level = order, depth[order]
    # the parent is the last node one level higher that was met before
    parents = np.where(level > 1, np.searchsorted(key, (level - 1) * (total + 1) + met), 0)
    number = np.empty(total, np.int64)
    number[order] = np.arange(1, total + 1)
    last = np.zeros(len(size), np.int64)
    ends = new > 0
    last[ends] = number[(first + new - 1)[ends]]
    return Louds.of(parents, h[row[order]]), np.append(0, level), last, row[order]


def _walk(node: int, parents: np.ndarray) -> list[int]:
    """The nodes from below the root down to ``node``."""
    out = []
    while node:
        out.append(node)
        node = int(parents[node - 1])
    return out[::-1]


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard.  Upper nodes have a key and sums of what stands below them without other upper nodes."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    paths = pa.concat_arrays([b.column(1) for b in batches])
    at = np.asarray(paths.offsets, np.int64)
    turns = paths.values.slice(at[0], at[-1] - at[0])
    at = at - at[0]
    h = np.stack([turns.field(i).to_numpy() for i in range(2)], axis=1).reshape(-1, 2)
    ids, n, ends = (table.column(i).to_numpy() for i in (0, 2, 3))
    trie, depth, last, row = build(h, at)
    parents, degree, levels = trie.parents(), trie.degrees(), trie.levels()
    nodes = len(depth)
    weight = np.append(0, turns.field(2).to_numpy()[row])
    upper = np.zeros(nodes, bool)
    upper[0] = True
    keys: dict[int, bytes] = {0: ROOT_KEY}
    for node in (last[0], last[-1]):
        key = ROOT_KEY
        for x in _walk(int(node), parents):
            key = hashlib.blake2b(key + trie.labels[x - 1].tobytes(), digest_size=16).digest()
            keys[x], upper[x] = key, True
    members, lowest, digest = np.zeros(nodes, np.int64), np.full(nodes, np.iinfo(np.int64).max), np.full(nodes, None, object)
    members[last], lowest[last], digest[last] = n, ids, ends
    for level in reversed(levels):
        np.add.at(members, parents[level.start - 1 : level.stop - 1], members[level])
        np.minimum.at(lowest, parents[level.start - 1 : level.stop - 1], lowest[level])
    leaves = np.where(upper, 0, degree == 0).astype(np.int64)
    saved = np.where(upper, 0, (members - 1) * weight)
    inner = degree.astype(np.int64)
    np.subtract.at(inner, parents[np.flatnonzero(upper[1:])], 1)
    for level in reversed(levels):
        own = np.flatnonzero(~upper[level]) + level.start
        np.add.at(leaves, parents[own - 1], leaves[own])
        np.add.at(saved, parents[own - 1], saved[own])
    above = np.append(0, parents)
    key = [keys.get(i) for i in range(nodes)]
    schema = to_arrow_schema(_NODE)
    parent_upper = upper[above]
    parent_upper[0] = False
    columns = [
        key, [key[p] if u else None for p, u in zip(above.tolist(), parent_upper.tolist())], lowest, depth,
        pa.array(lowest[above], mask=upper[above]), members, inner, leaves, saved,
        [d if d or u else NO_MEMBER for d, u in zip(digest.tolist(), upper.tolist())], weight,
    ]
    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rollups of the upper nodes, whose own sums leave out other upper nodes."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches).sort_by("depth")
    columns = {c: table[c].to_numpy(zero_copy_only=False) for c in table.column_names}
    depth, members, weight = columns["depth"], columns["n_convs"], columns["weight"]
    children, leaves, saved = (columns[c].copy() for c in ("n_children", "n_leaves", "saved_tokens"))
    place = {k: i for i, k in enumerate(table["key"].to_pylist())}
    parents = np.array([place[k] if k is not None else 0 for k in table["parent_key"].to_pylist()], np.int64)
    np.add.at(children, parents[1:], 1)
    leaves += children == 0
    saved += (members - 1) * weight
    starts = np.searchsorted(depth, np.arange(1, int(depth[-1]) + 2))
    for lo, hi in zip(starts[:-1][::-1].tolist(), starts[1:][::-1].tolist()):
        np.add.at(leaves, parents[lo:hi], leaves[lo:hi])
        np.add.at(saved, parents[lo:hi], saved[lo:hi])
    lowest = columns["conv_id"]
    above = pa.array(lowest[parents], mask=depth == 0)
    columns |= {"parent_conv_id": above, "n_children": children, "n_leaves": leaves, "saved_tokens": saved}
    columns["ends_sha256"] = [d or NO_MEMBER for d in table["ends_sha256"].to_pylist()]
    columns["key"], columns["parent_key"] = table["key"].combine_chunks(), table["parent_key"].combine_chunks()
    schema = to_arrow_schema(_NODE)
    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for f in schema for c in (columns[f.name],)], schema=schema)


def prefix_trie(lists: DataFrame, scratch: Scratch, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``lists`` (conv_id, path), see ``NODE_COLUMNS``."""
    spark = lists.sparkSession
    paths = scratch.table(distinct_paths(lists))
    turns = paths.agg(F.sum(F.size("path"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(turns / shard_turns))
    dealt = paths.select("conv_id", "path", "n", "ends").repartitionByRange(shards, "path").sortWithinPartitions("path")
    nodes = scratch.table(dealt.mapInArrow(_shard, _NODE))
    first = lambda c: F.min(c).alias(c)
    whole = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = nodes.where("key is not null").groupBy("key").agg(*[first(c) for c in ("parent_key", "conv_id", "depth", "parent_conv_id")], *whole, F.max("ends_sha256").alias("ends_sha256"), first("weight"))
    # as many as two paths of each shard have
    upper = scratch.table(merged.select(*_NODE.names).coalesce(1).mapInArrow(_top, _NODE))
    lower = nodes.where("key is null")
    hung = lower.where("parent_key is not null").drop("parent_conv_id").join(upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "parent_key")
    return upper.select(*NODE_COLUMNS).unionByName(lower.where("parent_key is null").select(*NODE_COLUMNS)).unionByName(hung.select(*NODE_COLUMNS))


def shard_tries(lists: DataFrame, shards: int) -> DataFrame:
    """The succinct tries themselves, one row a shard: ``nodes``, ``louds`` (bits, first bit lowest) and ``labels`` (16 bytes a node but the root)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0) for b in batches if b.num_rows]
        if parts:
            paths = pa.concat_arrays(parts)
            at = np.asarray(paths.offsets, np.int64)
            h = np.stack([paths.values.field(i).to_numpy()[at[0] : at[-1]] for i in range(2)], axis=1).reshape(-1, 2)
            trie = build(h, at - at[0])[0]
            yield pa.RecordBatch.from_pydict({"nodes": [len(trie.labels) + 1], "louds": [np.packbits(trie.bits, bitorder="little").tobytes()], "labels": [trie.labels.tobytes()]})

    paths = distinct_paths(lists).select("path").repartitionByRange(shards, "path").sortWithinPartitions("path")
    return paths.mapInArrow(run, "nodes long, louds binary, labels binary")


def rebuilt(lists: DataFrame) -> DataFrame:
    """op11's conversations: c takes its first h turns from conversation c - c % 100, h = crc32(c) % 6, and keeps its own after the first h."""
    c = F.col("conv_id")
    shared = lists.where(c % 100 == 0).select(c.alias("base"), F.slice("path", 1, SHARED_TURNS).alias("base_path"))
    h = (F.crc32(c.cast("string").cast("binary")) % (SHARED_TURNS + 1)).cast("int")
    taken: Column = F.when(F.col("base_path").isNull() | (F.col("h") == 0), F.slice("path", 1, F.lit(0))).otherwise(F.slice("base_path", F.lit(1), F.col("h")))
    own = F.slice("path", F.col("h") + 1, F.greatest(F.size("path"), F.lit(1)))
    joined = lists.withColumns({"base": c - c % 100, "h": h}).join(shared, "base", "left")
    return joined.select("conv_id", F.concat(taken, own).alias("path"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "prefix-trie")
    lists = turn_lists(read_table(spark, sf_dir, "conversations"), scratch)
    return prefix_trie(scratch.table(rebuilt(lists)), scratch)
