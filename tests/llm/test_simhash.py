"""SimHash components against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import types as T

from tidemark.llm import simhash

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("a.b", T.StringType()), T.StructField("FINGERPRINT", T.StringType())])


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{node: smallest node reachable} over ``prints`` {node: fingerprint}."""
    root = {n: n for n in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = sorted(prints)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in prints}


def texts(rng):
    vocabulary = [f"w{i}" for i in range(60)]
    out = [None, "", " \t\n", "one", "One  two", "ONE two", "äöÜ ß three", "three"]
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(3, 60))
        out.append(" ".join(base))
        for _ in range(4):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
    return out + out[8:14] + [" ".join(rng.choices(vocabulary, k=3000))]


@pytest.mark.parametrize("small_bucket", [1, 16])
def test_components(spark, small_bucket):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts(random.Random(5)))]
    got = simhash.simhash_components(spark.createDataFrame(rows, SCHEMA), small_bucket=small_bucket)
    assert got.columns == ["doc_id", "text", "a.b", "fingerprint", "component_id"]
    prints = {i: plain_fingerprint(t) for i, t, *_ in rows}
    wanted = plain_components(prints)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got.collect()} == {(i, f"{p:016x}", wanted[i]) for i, p in prints.items()}


@pytest.mark.parametrize("small_bucket", [1, 4, 16])
def test_links_of_crowded_fingerprints(spark, small_bucket):
    """Chains and clouds around a few values: most buckets are shared by many; no link between components is lost."""
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1}
    for _ in range(3):
        at = rng.getrandbits(64)
        for _ in range(60):
            prints.add(at)
            for _ in range(rng.choice([1, 2, 2, 3, 4])):
                at ^= 1 << rng.randrange(64)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash.links(frame, simhash.Scratch(spark, "t"), small_bucket).collect()
    mask = (1 << 64) - 1
    assert all(((r.a ^ r.b) & mask).bit_count() <= 2 for r in found)
    wanted = plain_components({p: p & mask for p in signed})
    root = {p: p for p in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        x, y = find(r.a), find(r.b)
        root[max(x, y)] = min(x, y)
    assert {p: find(p) for p in signed} == wanted


def test_blocks_and_long_texts():
    words = [f"word{i % 37}" for i in range(2000)]
    text = " ".join(words).encode()
    whole = b"".join(simhash.shingle_digests(text))
    assert whole == b"".join(simhash.shingle_digests(text, block=50))
    assert len(whole) == 8 * 1998
    assert int.from_bytes(simhash.fingerprint(text), "big") == plain_fingerprint(text.decode())


def test_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d", None, None), (None, "a b c d", None, None), (3, "e f g h i", None, None), (3, "e f g h i", None, None)]
    got = [(r.doc_id, r.component_id) for r in simhash.simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == [(3, 3), (3, 3), (None, None), (None, None)]
    assert simhash.simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    wanted = plain_components(prints)
    got = simhash.op13_simhash(spark, folder).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{p:016x}", wanted[i]) for i, p in prints.items()}
