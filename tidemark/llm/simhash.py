"""Near-duplicates by SimHash: fingerprints, a join on blocks of their bits, verification of the Hamming distance.

A text's fingerprint has a bit set where over half of the XXH64 values (seed 42) of its three-word shingles have
it.  Fingerprints are cut into four blocks of 16 bits; two that differ in at most two bits agree in two blocks at
least, so each gets the six pairs of its blocks as keys, and fingerprints that share a key are compared inside the
join.  Documents of one fingerprint are one node before anything is joined.

A key that more than ``SMALL_BUCKET`` fingerprints share isn't compared pair by pair.  Its fingerprints are joined
by their single-bit flips instead: two fingerprints differ in at most two bits exactly if a value is at most one
flip away from both, and at most 65 different fingerprints are that near to one value, so links of such a bucket
grow with its fingerprints and none is lost.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero and are linked like any
other; texts of one or two words have one shingle, all their words; repeated rows each keep a row; a component is
named by its smallest id that isn't null (null if all are); an empty table gives an empty table; input columns
named like an output column are replaced, all others are passed through; long texts are hashed in blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, arrow_map, quoted, read_table, without
from .near_dedup import components

WIDTH = 3
SEED = 42
#: Bits in which linked fingerprints may differ.
DISTANCE = 2
BLOCKS = 4
#: Buckets up to this size are compared pair by pair.
SMALL_BUCKET = 16
_BLOCK_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def shingle_digests(text: bytes, width: int = WIDTH, block: int = _BLOCK_BYTES) -> Iterator[bytes]:
    """XXH64 digests (big-endian) of a text's shingles, end to end, block by block."""
    from xxhash import xxh64_digest

    at, some, tail = 0, False, []
    while at < len(text):
        stop = min(at + block, len(text))
        if stop < len(text):
            gap = _SPACE.search(text, stop)
            stop = gap.start() if gap else len(text)
        words = tail + text[at:stop].lower().split()
        if len(words) >= width:
            line = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            yield b"".join([xxh64_digest(line[i : j - 1], SEED) for i, j in zip([0, *ends], ends[width - 1 :])])
            some = True
        tail, at = words[1 - width :], stop
    if tail and not some:
        yield xxh64_digest(b" ".join(tail), SEED)


def fingerprint(text: bytes) -> bytes:
    """The fingerprint, big-endian."""
    ones, n = np.zeros(64, np.int64), 0
    for digests in shingle_digests(text):
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(bits)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(df: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "fingerprint") -> DataFrame:
    """``df`` (its columns ``keep``, all by default) with the fingerprint of ``text`` as a long."""

    def run(batches):
        for (array,) in batches:
            values = array.fill_null("").cast(pa.large_binary())
            made = b"".join(fingerprint(x.as_py()) for x in values)
            yield slice(0, len(array)), [pa.array(np.frombuffer(made, ">i8").astype(np.int64))]

    keep = [c for c in (df.columns if keep is None else keep) if c.lower() != out.lower()]
    return arrow_map(df, [quoted(text)], keep, [T.StructField(out, T.LongType())], run)


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """Masks (as signed longs) of all choices of ``blocks - distance`` blocks of 64 bits."""
    width = 64 // blocks
    masks = [sum(((1 << width) - 1) << (width * i) for i in chosen) for chosen in combinations(range(blocks), blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, scratch: Scratch, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """Links (a, b) between the different fingerprints ``prints`` (fp): all of small buckets, in larger ones a star
    around the smallest fingerprint of each value that is one flip away."""
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in block_masks()])
    keyed = prints.select("fp", F.posexplode(keys).alias("k", "v"))
    shared = scratch.table(keyed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = scratch.table(keyed.join(shared, ["k", "v"]))
    few = members.where(F.col("n") <= small_bucket).select("k", "v", "fp")
    near = (F.col("x.fp") < F.col("y.fp")) & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= DISTANCE)
    pairs = few.alias("x").join(few.alias("y"), (F.col("x.k") == F.col("y.k")) & (F.col("x.v") == F.col("y.v")) & near)
    many = members.where(F.col("n") > small_bucket).select("fp").distinct()
    flips = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    around = many.select("fp", F.explode(flips).alias("value")).groupBy("value").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    star = around.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))
    return pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).unionByName(star)


def simhash_components(df: DataFrame, id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """``df`` (its columns ``keep``, all by default) with ``fingerprint`` (hex) and ``component_id``."""
    rest = without(df if keep is None else df.select(*[quoted(c) for c in keep]), ["fingerprint", "component_id"]).columns
    scratch = Scratch(df.sparkSession, "simhash")
    named = df.withColumn("__tm_id", quoted(id_col))
    docs = scratch.table(fingerprints(named, text, [*rest, "__tm_id"], "__tm_fp"))
    nodes = scratch.table(docs.groupBy(F.col("__tm_fp").alias("fp")).agg(F.min("__tm_id").alias("first")))
    roots = components(scratch.table(links(nodes.select("fp"), scratch, small_bucket)), scratch).select(F.col("t").alias("fp"), "root")
    last = scratch.made - 1
    # a root is a node too; it isn't among the rows of ``roots``
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = scratch.table(placed.groupBy("root").agg(F.min("first").alias("component_id")))
    classes = scratch.table(placed.join(lowest, "root").select(F.col("fp").alias("__tm_fp"), "component_id"))
    scratch.drop(1, last + 2)
    return docs.join(classes, "__tm_fp").select(
        *[quoted(c) for c in rest], F.lower(F.lpad(F.hex("__tm_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_components(docs, keep=["doc_id"]).select("doc_id", "fingerprint", "component_id")
