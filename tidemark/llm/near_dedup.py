"""Near-duplicate classes by ProbMinHash over weighted word shingles.

A text is the set of its five-word shingles; one that occurs n times weighs 1 + ln n, so that a line
repeated hundreds of times doesn't outweigh the rest of its text.  Every shingle is a
Poisson process of its weight whose arrivals fall on registers; a register keeps the shingle that
arrives first, and a shingle stops as soon as its next arrival is later than every register's
(early termination).  Two signatures agree in a register with probability J_P, the probability
Jaccard similarity.  Registers make 36 bands of 7: two texts of similarity 0.8 share none with probability
0.0002, two of 0.5 share one with 0.25.  Texts that share a band are candidates, and
candidates are verified on their shingles: similarity is the exact J_P or, if larger, the Jaccard
index of the shingle sets.  A text that repeats a shingle has the bands of its plain set besides, so a copy
with repeated lines is a candidate too.

Equal texts are one node from the start (every row is signed; equal ones meet before bands are joined).  In a bucket of
up to ``SMALL_BUCKET`` texts all pairs are candidates; a text of larger ones is paired with the first text
among them.  Larger buckets that still span several classes are then closed: all their pairs across classes
are compared, block by block, so that no task holds more than two blocks of a bucket.  The bucket's main class
is compared with the other texts only.  A first closing takes each text in its largest bucket alone, which
joins most classes; the second takes all buckets and leaves no pair that shares a band untried.  Classes are
the components of the verified links, found by large-star and small-star steps; every intermediate is a table
in the shared folder, deleted when it is no longer needed.

Defined cases: null texts and texts without words are each a class of their own; texts of fewer
than five words are one shingle of all their words; equal texts are one class; a class's id is its
smallest id (null ids count only where there is no other); rows equal in id and text share their
flag in ``near_duplicates``, and ``deduplicate`` keeps one of them; empty tables give empty tables;
input columns named like an output column are replaced, others are passed through; texts of any
length are used whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import Scratch, arrow_map, quoted, read_table, without
from .textnum import ROW_BITS, mix64, shingles_of, word_chunks, words_of

WIDTH = 5
SIMILARITY = 0.8
#: A power of two; the first BANDS * BAND_ROWS of them make bands.
REGISTERS = 256
BANDS, BAND_ROWS = 36, 7
SMALL_BUCKET = 4
#: Texts and bytes of text in a block of a large bucket, about.
BLOCK_TEXTS = 1024
BLOCK_BYTES = 8 << 20
_COLUMNS = 1 << 12
_CHUNK = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, weight) of the distinct shingles of each row, in order of row and shingle."""
    rows = len(bounds) - 1
    bits = np.uint64(ROW_BITS)  # the same for every batch: a shingle's bits mustn't depend on its neighbours
    row = np.repeat(np.arange(rows, dtype=np.uint64), np.diff(bounds))
    key = np.sort((row << (np.uint64(64) - bits)) | (hashes >> bits))
    if not len(key):
        return np.zeros(0, np.int64), key, np.zeros(0)
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    weight = weight_of(np.diff(np.append(heads, len(key))))
    key = key[heads]
    return (key >> (np.uint64(64) - bits)).astype(np.int64), key << bits, weight


def weight_of(count: np.ndarray) -> np.ndarray:
    """Weights of shingles that occur so often."""
    return 1.0 + np.log(count)


def prob_minhash(row: np.ndarray, item: np.ndarray, weight: np.ndarray, rows: int, registers: int = REGISTERS) -> np.ndarray:
    """Signatures (rows x registers): the item that arrives first at each register; 0 for empty rows.

    An item visits the registers in an order of its own, without repeats; its k-th new register
    comes at rate weight * (registers - k) / registers.
    """
    first = np.full(rows * registers, np.inf)
    sig = np.zeros(rows * registers, dtype=np.uint64)
    seed = mix64(item + _STEP)
    place = (seed & np.uint64(registers - 1)).astype(np.int64)
    stride = ((seed >> np.uint64(32)) & np.uint64(registers - 1)).astype(np.int64) | 1
    time = np.zeros(len(item))
    latest = np.full(rows, np.inf)
    for k in range(registers):
        seed = mix64(seed + _STEP)
        gap = -np.log1p(-((seed >> np.uint64(11)).astype(float) * 2.0**-53))
        time = time + gap * (registers / (registers - k)) / weight
        on = np.flatnonzero(time < latest[row])
        if len(on) < len(row):
            row, item, weight, seed, place, stride, time = (x[on] for x in (row, item, weight, seed, place, stride, time))
        if not len(row):
            break
        at = row * registers + place
        np.minimum.at(first, at, time)
        won = first[at] == time
        sig[at[won]] = item[won]
        latest = first.reshape(rows, registers).max(axis=1)
        place = (place + stride) & (registers - 1)
    return sig.reshape(rows, registers)


def band_hashes(sig: np.ndarray, bands: int = BANDS, width: int = BAND_ROWS) -> np.ndarray:
    """One hash per row and band."""
    rows = len(sig)
    part = sig[:, : bands * width].reshape(rows, bands, width)
    acc = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), (rows, bands)).copy()
    for k in range(part.shape[2]):
        acc = mix64(acc * _STEP + part[:, :, k])
    return acc.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """J_P estimated from two signatures."""
    return float((a == b).mean())


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of exact J_P and set Jaccard of two texts given as (sorted shingles, weights)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    union = len(a[0]) + len(b[0]) - len(common)
    plain = len(common) / union
    if a[1].max() == 1 and b[1].max() == 1:
        return plain
    only_a, only_b = a[1].sum() - a[1][i].sum(), b[1].sum() - b[1][j].sum()
    both, n = np.unique(np.stack([a[1][i], b[1][j]], axis=1), axis=0, return_counts=True)
    total = 0.0
    for (x, y), count in zip(both, n, strict=True):
        spread = (np.maximum(both[:, 0] / x, both[:, 1] / y) * n).sum() + only_a / x + only_b / y
        total += count / spread
    return max(plain, total)


def shingle_weights(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    hashes, _ = shingles_of(words_of(data, np.array([0, len(data)])), WIDTH)
    own, count = np.unique(hashes, return_counts=True)
    return own, weight_of(count)


def signature_bands(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(band hashes, bounds) of rows of shingles: bands of the weighted signature and, where a shingle repeats,
    also of the plain set's, so that what either similarity accepts is a candidate."""
    n = len(bounds) - 1
    row, item, weight = weighted_shingles(hashes, bounds)
    full = np.diff(bounds) > 0
    again = np.zeros(n, dtype=bool)
    again[row[weight > 1]] = True
    on = again[row]
    plain = prob_minhash((np.cumsum(again) - 1)[row[on]], item[on], np.ones(int(on.sum())), int(again.sum()))
    ends = np.concatenate([[0], np.cumsum(full * BANDS + again * BANDS)])
    out = np.zeros(int(ends[-1]), dtype=np.int64)
    each = np.arange(BANDS)
    out[ends[:-1][full][:, None] + each] = band_hashes(prob_minhash(row, item, weight, n)[full])
    out[ends[:-1][again][:, None] + BANDS + each] = band_hashes(plain)
    return out, ends


def _signatures(batches):
    for (array,) in batches:
        for rows, words in word_chunks(array, _CHUNK):
            bands, ends = signature_bands(*shingles_of(words, WIDTH))
            yield rows, [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands))]


def _verify(threshold: float):
    def run(batches):
        known: dict[int, tuple] = {}
        for b in batches:
            left, right = b.column(0).to_pylist(), b.column(1).to_pylist()
            mine, other = b.column(2), b.column(3)
            ok = np.zeros(len(left), dtype=bool)
            for i in range(len(left)):
                if right[i] not in known:
                    known = {right[i]: shingle_weights(other[i].as_py())}  # rows come by their right text
                ok[i] = similarity(shingle_weights(mine[i].as_py()), known[right[i]]) >= threshold
            yield pa.RecordBatch.from_arrays([pa.array(np.array(left, np.int64)[ok]), pa.array(np.array(right, np.int64)[ok])], names=["a", "b"])

    return run


def _text_key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    one = pairs.join(texts.select(F.col("t").alias("a"), F.col("text").alias("text_a")), "a")
    both = one.join(texts.select(F.col("t").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(threshold), "a long, b long")


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(t, root) of every node of ``edges`` (a, b): root is the smallest node of its component."""
    scratch = scratch or Scratch(edges.sparkSession, "components")
    first = scratch.made
    tables = scratch.table(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = tables.unionByName(tables.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every neighbour above u joins the lowest around u
        big = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its neighbours below join the lowest of them
        floor = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(floor, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(floor.select("u", F.col("m").alias("v"))).distinct()
        tables = scratch.table(small)
        now = tables.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(first, scratch.made - 1)
        first = scratch.made - 1
        if now == seen:
            return tables.select(F.col("u").alias("t"), F.col("v").alias("root"))
        seen = now


def _merged(roots: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``roots`` (t, root) after new ``links`` (a, b): only the classes that the links touch are put together anew."""
    at = lambda side: links.select(F.col(side).alias("t")).distinct().join(roots, "t", "left").select(F.col("t").alias(side), F.coalesce("root", "t").alias(f"root_{side}"))
    classes = components(links.join(at("a"), "a").join(at("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), scratch)
    classes = classes.select(F.col("t").alias("root"), F.col("root").alias("top"))
    every = roots.unionByName(classes.select(F.col("root").alias("t"), "root"))
    return scratch.table(every.join(classes, "root", "left").select("t", F.coalesce("top", "root").alias("root")).where("t != root"))


def _candidates(members: DataFrame) -> DataFrame:
    """First pairs of the buckets ``members`` (band, t, n): each text of larger buckets with the first text it
    shares one with, and all pairs of small buckets."""
    large = members.where(F.col("n") > SMALL_BUCKET)
    firsts = large.groupBy("band").agg(F.min("t").alias("first"))
    star = large.join(firsts, "band").groupBy("t").agg(F.min("first").alias("b")).where("t != b").select(F.col("t").alias("a"), "b")
    few = members.where(F.col("n") <= SMALL_BUCKET).select("band", "t")
    pairs = few.alias("x").join(few.alias("y"), "band").where("x.t > y.t").select(F.col("x.t").alias("a"), F.col("y.t").alias("b"))
    return star.unionByName(pairs).distinct()


def _block_weights(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle's number, weight) of the distinct shingles of each text, in order of row and number."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part, words in word_chunks(texts, _CHUNK):
        own, bounds = shingles_of(words, WIDTH)
        hashes.append(own)
        rows.append(part.start + np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)))
    every, number = np.unique(np.concatenate(hashes), return_inverse=True)
    key, count = np.unique(np.concatenate(rows) * max(1, len(every)) + number, return_counts=True)
    return key // max(1, len(every)), key % max(1, len(every)), weight_of(count)


def _overlaps(row: np.ndarray, item: np.ndarray, weight: np.ndarray, left: np.ndarray, right: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of ``left`` and ``right`` the number of common shingles, and a bound of J_P: the smaller
    of the shares of weight that either text has in common shingles."""
    common = np.zeros((len(left), len(right)), np.float32)
    share_l, share_r = (common, common) if (weight == 1).all() else (np.zeros_like(common), np.zeros_like(common))
    total = np.bincount(row, weights=weight, minlength=rows)
    several = np.bincount(item)[item] > 1 if len(item) else np.zeros(0, bool)
    order = np.flatnonzero(several)[np.argsort(item[several], kind="stable")]
    row, weight = row[order], weight[order]
    column = np.unique(item[order], return_inverse=True)[1]
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, _COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + _COLUMNS])
        has = np.zeros((rows, min(_COLUMNS, width - start)), np.float32)
        has[row[lo:hi], column[lo:hi] - start] = 1
        common += has[left] @ has[right].T
        if share_l is not common:
            mass = np.zeros_like(has)
            mass[row[lo:hi], column[lo:hi] - start] = weight[lo:hi] / total[row[lo:hi]]
            share_l += mass[left] @ has[right].T
            share_r += has[left] @ mass[right].T
    return common, np.minimum(share_l, share_r)


def block_links(texts: pa.Array, roots: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links between rows of ``left`` and of ``right`` that join all their classes that any pair's similarity joins."""
    row, item, weight = _block_weights(texts)
    size = np.bincount(row, minlength=len(texts))
    repeats = np.bincount(row, weights=weight > 1, minlength=len(texts)) > 0
    common, bound = _overlaps(row, item, weight, left, right, len(texts))
    union = size[left][:, None] + size[right][None, :] - common.astype(np.int64)
    plain = common.astype(float) / np.maximum(union, 1)
    apart = roots[left][:, None] != roots[right][None, :]
    sure = apart & (plain >= threshold)
    # where neither text repeats a shingle J_P is the Jaccard index; else it is computed if its bound allows
    maybe = apart & ~sure & (repeats[left][:, None] | repeats[right][None, :]) & (bound >= threshold - 1e-4)
    head = {r: r for r in set(roots.tolist())}

    def find(x: int) -> int:
        while head[x] != x:
            head[x] = head[head[x]]
            x = head[x]
        return x

    bounds = np.searchsorted(row, np.arange(len(texts) + 1))
    weights = lambda r: (item[bounds[r] : bounds[r + 1]], weight[bounds[r] : bounds[r + 1]])
    out = []
    for pairs, known in ((sure, True), (maybe, False)):
        for i, j in zip(*(x.tolist() for x in np.nonzero(pairs)), strict=True):
            a, b = int(left[i]), int(right[j])
            x, y = find(int(roots[a])), find(int(roots[b]))
            if x != y and (known or similarity(weights(a), weights(b)) >= threshold):
                head[max(x, y)] = min(x, y)
                out.append((a, b))
    return out


def _closed(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        t, roots = table["t"].to_numpy(), table["root"].to_numpy()
        near = table["near"].to_numpy().astype(bool)
        # the first block of the main class stands for the pairs inside the near block too
        both = table["main"][0].as_py() and table["j"][0].as_py() == 0
        left, right = np.flatnonzero(near), np.arange(len(t)) if both else np.flatnonzero(~near)
        links = np.array(block_links(table["text"].combine_chunks(), roots, left, right, threshold), np.int64).reshape(-1, 2)
        return pa.table({"a": t[links[:, 0]], "b": t[links[:, 1]]})

    return run


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of larger buckets with their classes; small buckets have no pair left to try."""
    return members.where(F.col("n") > SMALL_BUCKET).select("t", "band", "size", "n").join(roots, "t", "left").withColumn("root", F.coalesce("root", "t"))


def _closing_links(placed: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join the classes in each bucket of ``placed``: every pair across classes is compared.

    Texts outside a bucket's main class (near) and those in it are dealt into blocks; every two near blocks
    meet, and every near block meets every block of the main class.
    """
    classes = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("size").alias("s"), F.bit_xor(F.xxhash64("t")).alias("who"))
    spans = classes.groupBy("band").agg(
        F.count(F.lit(1)).alias("roots"), F.sum("c").alias("n"), F.sum("s").alias("bytes"), F.bit_xor("who").alias("who"), F.max(F.struct("c", "root", "s")).alias("top")
    )
    # buckets of the same texts are one
    spans = spans.where("roots > 1").groupBy("who", "n").agg(F.min(F.struct("band", "bytes", "top")).alias("one")).select("n", "one.*")
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK_TEXTS), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")
    spans = spans.select("band", F.col("top.root").alias("top"), blocks(F.col("n") - F.col("top.c"), F.col("bytes") - F.col("top.s")).alias("nears"), blocks(F.col("top.c"), F.col("top.s")).alias("mains"))
    rows = placed.select("t", "band", "root").join(spans, "band").withColumn("near", F.col("root") != F.col("top"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("t"), F.when(F.col("near"), F.col("nears")).otherwise(F.col("mains"))).cast("int"))
    meet = lambda i, j, main, near: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(main).alias("main"), near.alias("near"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    block = F.col("block")
    among = F.transform(F.filter(upto(F.col("nears")), lambda k: k != block), lambda k: meet(F.least(k, block), F.greatest(k, block), False, block < k))
    near = F.concat(F.transform(upto(F.col("mains")), lambda k: meet(block, k, True, F.lit(True))), among)
    main = F.transform(upto(F.col("nears")), lambda k: meet(k, block, True, F.lit(False)))
    rows = rows.select("t", "band", "root", F.explode(F.when(F.col("near"), near).otherwise(main)).alias("m")).select("t", "band", "root", "m.*")
    return rows.join(texts, "t").groupBy("band", "i", "j", "main").applyInArrow(_closed(threshold), "a long, b long")


def text_classes(df: DataFrame, id_col: str, text: str, threshold: float = SIMILARITY) -> DataFrame:
    """(k1, k2, root, class_id, first_id, keeper): the class of each distinct text with words.

    ``keeper`` marks the text of the class whose smallest id is the class's id.
    """
    k1, k2 = _text_key(quoted(text))
    narrow = df.where(quoted(text).isNotNull()).select(quoted(text).alias("text"), quoted(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"))
    signed = arrow_map(narrow.withColumn("size", F.octet_length("text").cast("long")), [F.col("text")], ["k1", "k2", "id", "size"], [T.StructField("bands", T.ArrayType(T.LongType()))], _signatures)
    # rows of one text have one signature; any of them stands for all
    nodes = signed.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.max("size").alias("size"), F.max("bands").alias("bands")).where(F.size("bands") > 0)
    scratch = Scratch(df.sparkSession, "near-dup")
    nodes = scratch.table(nodes.withColumn("t", F.monotonically_increasing_id()))
    members = nodes.select("t", "size", F.explode(F.array_distinct("bands")).alias("band"))
    members = scratch.table(members.join(members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "band"))
    wanted = members.select("t").distinct().join(nodes.select("t", "k1", "k2", "id"), "t")
    texts = narrow.join(wanted.select("t", F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.col("id").alias("w_id")), (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")) & F.col("id").eqNullSafe(F.col("w_id")))
    texts = scratch.table(texts.select("t", "text"))
    pairs = scratch.table(_candidates(members))
    roots, kept = components(_verified(pairs, texts, threshold), scratch), scratch.made - 1
    scratch.drop(3, kept)
    largest = Window.partitionBy("t").orderBy(F.col("n").desc(), "band")
    for first in (True, False):
        placed = _placed(members, roots)
        if first:
            placed = placed.withColumn("place", F.row_number().over(largest)).where("place = 1")
        more = scratch.table(_closing_links(placed, texts, threshold))
        if not more.isEmpty():
            old, roots, kept = kept, _merged(roots, more, scratch), scratch.made - 1
            scratch.drop(old, kept)
    scratch.drop(1, kept)
    placed = nodes.select("k1", "k2", "t", "id").join(roots, "t", "left").withColumn("root", F.coalesce("root", "t"))
    # the class's text is the one with the smallest id, then the lowest node
    head = placed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("t").alias("t"))).alias("h"), F.count(F.lit(1)).alias("class_texts"))
    return placed.join(head, "root").select("k1", "k2", F.col("h.id").alias("class_id"), F.col("id").alias("first_id"), (F.col("t") == F.col("h.t")).alias("keeper"), "class_texts")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """``df`` with class_id (smallest id of the class; for texts without words their own) and ``kept``."""
    rest = without(df, ["class_id", "kept"]).columns
    classes = text_classes(df, id_col, text, threshold).select(
        F.col("k1").alias("__tm_k1"), F.col("k2").alias("__tm_k2"), F.col("class_id").alias("__tm_class"), F.col("first_id").alias("__tm_first"), F.col("keeper").alias("__tm_keeper")
    )
    k1, k2 = _text_key(quoted(text))
    joined = df.withColumns({"__tm_k1": k1, "__tm_k2": k2}).join(classes, ["__tm_k1", "__tm_k2"], "left")
    alone = F.col("__tm_keeper").isNull()
    return joined.select(
        *[quoted(c) for c in rest],
        F.when(alone, quoted(id_col)).otherwise(F.col("__tm_class")).alias("class_id"),
        (alone | (F.col("__tm_keeper") & quoted(id_col).eqNullSafe(F.col("__tm_first")))).alias("kept"),
    )


def deduplicate(df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """``df`` with one row of each class; texts without words all stay."""
    classes = text_classes(df, id_col, text, threshold).where("keeper").select(F.col("k1").alias("__tm_k1"), F.col("k2").alias("__tm_k2"), F.col("first_id").alias("__tm_first"))
    blank = ~F.coalesce(quoted(text), F.lit("")).rlike(r"[^ \t\n\x0B\f\r]")
    k1, k2 = _text_key(quoted(text))
    worded = df.where(~blank).withColumns({"__tm_k1": k1, "__tm_k2": k2})
    kept = worded.join(
        classes.withColumnsRenamed({"__tm_k1": "__tm_c1", "__tm_k2": "__tm_c2"}),
        (F.col("__tm_k1") == F.col("__tm_c1")) & (F.col("__tm_k2") == F.col("__tm_c2")) & quoted(id_col).eqNullSafe(F.col("__tm_first")),
    )
    one = kept.dropDuplicates(["__tm_k1", "__tm_k2"]) if _repeats(df, id_col, text) else kept
    return one.select(*[quoted(c) for c in df.columns]).unionByName(df.where(blank))


def _repeats(df: DataFrame, id_col: str, text: str) -> bool:
    """Whether some row repeats another's id and text."""
    k1, k2 = _text_key(quoted(text))
    again = df.where(quoted(text).isNotNull()).groupBy(quoted(id_col).alias("id"), k1.alias("k1"), k2.alias("k2")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return not again.isEmpty()


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "kept")
