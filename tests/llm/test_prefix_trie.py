"""Prefix tries against a dictionary of prefixes."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import prefix_trie

SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in ("conv_id", "turn")] + [T.StructField(n, T.StringType()) for n in ("role", "text", "depth", "a.b")])


def conversations(rows):
    out = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            out[r[0]].append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain(convs):
    """NODE_COLUMNS of each node, by definition."""
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    below = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        below[p] = (sum(below[q][0] for q in children[p]) or 1, own + sum(below[q][1] for q in children[p]))
    rows = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *below[p], sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def found(df):
    assert df.columns == prefix_trie.NODE_COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(rng, n=150):
    rows = []
    stock = [[("user", f"q{i}"), ("bot", f"a{i}"), ("user", "more"), ("bot", "é" * i)] for i in range(4)]
    for c in rng.sample(range(1000), n):
        turns = rng.choice(stock)[: rng.randint(0, 4)] + [(rng.choice(["user", None]), rng.choice(["x", "", None, f"t{rng.randint(0, 9)}"])) for _ in range(rng.choice([0, 0, 1, 3, 9]))]
        rows += [(c, rng.choice([i, i, i, None]), r, t, "n", "m") for i, (r, t) in enumerate(turns)] or [(c, None, None, None, "n", "m")]
    return rows + rows[:7] + [(None, 1, "user", "nobody", "", "")]


@pytest.mark.parametrize("partitions", [1, 5, 23])
def test_nodes_whatever_the_shards(spark, partitions):
    rows = made(random.Random(partitions))
    rows += [(2000 + i, 0, "user", "the same", "", "") for i in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        scratch = prefix_trie.Scratch(spark, "t")
        lists = scratch.table(prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA), scratch))
        assert found(prefix_trie.prefix_trie(lists, scratch)) == plain(conversations(rows))
        again = scratch.table(prefix_trie.rebuilt(lists))
        assert found(prefix_trie.prefix_trie(again, scratch)) == plain(rebuilt(conversations(rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_long_conversation_and_empty_table(spark):
    rows = [(1, i, "user", f"t{i % 7}", "", "") for i in range(700)] + [(2, i, "user", f"t{i % 7}", "", "") for i in range(350)]
    scratch = prefix_trie.Scratch(spark, "t")
    lists = prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA), scratch)
    assert found(prefix_trie.prefix_trie(lists, scratch)) == plain(conversations(rows))
    nobody = prefix_trie.turn_lists(spark.createDataFrame([(None, 1, "a", "b", "", "")], SCHEMA), scratch)
    assert prefix_trie.prefix_trie(nobody, scratch).count() == 0


def test_query_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(prefix_trie.op11_prefix_trie(spark, folder)) == plain(rebuilt(conversations(rows)))


def test_bits_of_a_small_trie(spark):
    # a, a b, a c, d  ->  root (2 children), a (2), d (0), b (0), c (0)
    h = np.array([[1, 0], [1, 0], [2, 0], [1, 0], [3, 0], [4, 0]])
    trie, depth, last, _ = prefix_trie.build(h, np.array([0, 1, 3, 5, 6]))
    assert "".join(map(str, trie.bits.astype(int))) == "110110000"
    assert trie.parents().tolist() == [0, 0, 1, 1] and trie.degrees().tolist() == [2, 2, 0, 0, 0]
    assert depth.tolist() == [0, 1, 1, 2, 2] and last.tolist() == [1, 3, 4, 2]
    assert [(x.start, x.stop) for x in trie.levels()] == [(1, 3), (3, 5)]
    scratch = prefix_trie.Scratch(spark, "t")
    lists = prefix_trie.turn_lists(spark.createDataFrame([(1, 0, "r", "a", "", ""), (2, 0, "r", "a", "", ""), (2, 1, "r", "b", "", "")], SCHEMA), scratch)
    (shard,) = prefix_trie.shard_tries(lists, 1).collect()
    assert (shard.nodes, bytes(shard.louds), len(shard.labels)) == (3, bytes([0b00101]), 32)


def test_ids_of_one_path_come_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 3)
    rows = [(i * 7 - 300, 0, "user", "same", "", "") for i in range(90)] + [(5000, 0, "user", "other", "", "")]
    scratch = prefix_trie.Scratch(spark, "t")
    lists = prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA), scratch)
    assert found(prefix_trie.prefix_trie(lists, scratch)) == plain(conversations(rows))
