"""Language-model scores from a probabilistic suffix tree over words.

Tokens are the words of a text (A-Z lower-cased) and one end.  The tree's root is the additively
smoothed word distribution of the training texts; deeper states are contexts of the last one to
``depth`` tokens.  A context is kept only if its next-token distribution diverges from that of the
next shorter context by more than its parameters cost (`MIN_DIVERGENCE`, `NATS_PER_ENTRY`),
so context lengths vary.  Next-token probabilities of a kept context are smoothed by its parent,
and what the context doesn't list is left to the parent, scaled to sum to one.  A token is scored
by the longest kept suffix of what precedes it.

Counts cover every training text, and the tree grows with them: a context lists every token that
followed it at least ``MIN_COUNT`` times, whatever the size of the corpus.  An n-gram of so many occurrences has a
beginning and an ending of as many, so each level needs only the n-grams whose two parts were listed.
The tree is a table keyed by 64-bit hashes of n-grams; contexts are tested by grouping and joining it.

Scoring needs no walk: the log probability of a text is a sum over its n-grams.  Let L(x) be the log
probability of the last token of n-gram x by its longest kept context.  Where the context c of x is kept,
x adds L(x) - L(ending of x) if it is listed and the log of c's share left to its parent if not;
all else adds nothing.  So every listed n-gram has one weight.  The weights of the n-grams (and the counts of
the words) that occur most often go to every task, in tables of fixed size; the others are joined
by their hashes, exactly.  A bitmap of fixed size keeps n-grams without a weight from that join; where the
tree outgrows it more rows are joined, and no score changes.

Words are 64-bit hashes (see textnum).  One scan of the texts for words, one per level, and one to score.

Defined cases: null and empty texts are one end token; rows whose id is null are scored and not
learned from; equal texts get equal scores (to rounding) and every row stays; with nothing to learn from every
token is unknown and has probability 1; input columns named like an output column are replaced,
others are passed through; texts of any length are scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Scratch, quoted, read_table, without
from .textnum import Words, mix64, word_chunks

DEPTH = 3
#: An n-gram is listed from so many occurrences on.
MIN_COUNT = 3
ALPHA = 0.1
#: What the parent's distribution weighs in a context, in occurrences.
PARENT_WEIGHT = 2.0
#: A context's mean divergence from its parent (nats a token) and the nats an entry must earn.
MIN_DIVERGENCE = 0.02
NATS_PER_ENTRY = 1.0
LEAST_GAIN = 4.0
#: Words and n-grams of highest count that every task holds; bits of a bitmap.
HEAD_WORDS, HEAD_GRAMS = 1 << 18, 1 << 21
FILTER_BITS = 26
END = np.uint64(0x656E642D6F662D74)
#: Keys gathered in a task before they are reduced to distinct ones.
GATHER = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)
_UNSTEP = np.uint64(pow(int(_STEP), -1, 1 << 64))
#: Bits of a frequent word's place in an n-gram's number; tokens for each task that sums n-grams.
HEAD_BITS = 18
TASK_TOKENS = 1 << 21
#: Rows whose answers are summed in one place, as a power of two.
ROW_BLOCK = 8


class HashIndex:
    """Places of 64-bit keys, looked up for whole arrays by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint64)
        bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        rest, step = np.arange(len(keys)), np.uint64(0)
        home = mix64(self.keys)
        while len(rest):
            at = (home[rest] + step) & self.mask
            free = self.slots[at] < 0
            self.slots[at[free]] = rest[free]  # of several keys the last one written stays
            rest = rest[self.slots[at] != rest]
            step += np.uint64(1)

    def __reduce__(self):
        return HashIndex, (self.keys,)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; -1 where it isn't one."""
        keys = keys.astype(np.uint64, copy=False)
        out = np.full(len(keys), -1, dtype=np.int64)
        if not len(self.keys):
            return out
        rest, at = np.arange(len(keys)), mix64(keys)
        while len(rest):
            slot = self.slots[at & self.mask]
            some = slot >= 0
            rest, at, slot = rest[some], at[some], slot[some]
            same = self.keys[slot] == keys[rest]
            out[rest[same]] = slot[same]
            rest, at = rest[~same], at[~same] + np.uint64(1)
        return out


class Bitmap:
    """A set of keys that may also hold others: one bit for each value of a key's last ``FILTER_BITS``."""

    def __init__(self, words: np.ndarray, values: np.ndarray):
        self.bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
        self.bits[words] = values

    @staticmethod
    def of(keys: DataFrame, key: str = "k") -> Bitmap:
        """The bitmap of a table's keys; what the driver receives is bounded by the bitmap's size."""
        low = F.col(key).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
        words = keys.select(low.alias("b")).select(F.shiftrightunsigned("b", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(b & 63 as int))").alias("v"))
        table = words.groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
        return Bitmap(table.column("w").to_numpy(), table.column("v").to_numpy().view(np.uint64))

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        low = keys & np.uint64((1 << FILTER_BITS) - 1)
        return (self.bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1)).astype(bool)


def text_tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, place in the text, row bounds) with the end token after each text's words."""
    counts = words.counts + 1
    bounds = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.empty(int(bounds[-1]), dtype=np.uint64)
    ends = bounds[1:] - 1
    inner = np.ones(len(tokens), dtype=bool)
    inner[ends] = False
    tokens[inner] = words.hashes
    tokens[ends] = END
    return tokens, np.arange(len(tokens)) - np.repeat(bounds[:-1], counts), bounds


def joined_key(beginning: np.ndarray, ending: np.ndarray) -> np.ndarray:
    """Key of the n-gram whose first and last n - 1 tokens have these keys."""
    return mix64(beginning * _STEP + mix64(ending + _STEP))


def grams(tokens: np.ndarray, place: np.ndarray, filters: list[Bitmap]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length from 2 on, (where it ends, key, key of its beginning, of its ending) of the n-grams
    whose two parts the length's filter may hold."""
    at, key = np.arange(len(tokens)), tokens
    for length, listed in enumerate(filters, 2):
        some = listed.may_hold(key)
        at, key = at[some], key[some]
        both = np.flatnonzero((at[1:] == at[:-1] + 1) & (place[at[1:]] >= length - 1)) + 1
        at, beginning, ending = at[both], key[both - 1], key[both]
        key = joined_key(beginning, ending)
        yield at, key, beginning, ending


def _packed_order(key: np.ndarray) -> np.ndarray:
    """The order of keys by their first bits: sorted with each one's place in its last bits, which is several
    times faster than an indirect sort."""
    low = np.uint64((1 << len(key).bit_length()) - 1)
    return (np.sort((key & ~low) | np.arange(len(key), dtype=np.uint64)) & low).astype(np.int64)


def _reduced(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys (rows of the last array; the others go with it) with repeats put together, and their summed counts.

    Two keys of the same first bits can leave a repeat, whose counts are summed later.
    """
    if not len(counts):
        return keys, counts
    order = _packed_order(keys[-1])
    own = keys[-1][order]
    heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    first = order[heads]
    return [k[first] for k in keys], np.add.reduceat(counts[order], heads)


class _Counter:
    """Keys (arrays; the last one identifies a row) with their counts, reduced about every ``GATHER`` rows."""

    def __init__(self, width: int):
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.keys, self.counts, self.fresh, self.held = [np.zeros(0, np.uint64)] * self.width, np.zeros(0, np.int64), [], 0

    def add(self, keys: list[np.ndarray]) -> None:
        self.fresh.append(keys)
        self.held += len(keys[0])
        if self.held >= GATHER:
            self.reduce()

    def reduce(self) -> None:
        if self.fresh:
            new, n = _reduced([np.concatenate(x) for x in zip(*self.fresh, strict=True)], np.ones(self.held, np.int64))
            self.keys, self.counts = _reduced([np.concatenate(x) for x in zip(self.keys, new, strict=True)], np.concatenate([self.counts, n]))
            self.fresh, self.held = [], 0


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = _Counter(1)

    def rows() -> Iterator[pa.RecordBatch]:
        for i in range(0, len(own.counts), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(own.keys[0][i : i + (1 << 17)].view(np.int64)), pa.array(own.counts[i : i + (1 << 17)])], names=["k", "c"])

    for b in batches:
        for _, w in word_chunks(b.column(0)):
            own.add([text_tokens(w)[0]])
            if len(own.counts) >= 2 * GATHER:
                yield from rows()
                own.clear()
    own.reduce()
    yield from rows()


class Named:
    """N-grams of words that are all among the most frequent ones, as numbers: a word is its place in that list, in as
    many bits as let the n-gram be one number.  Numbers are spread over 64 bits by a multiplication that can be undone."""

    def __init__(self, keys: np.ndarray, length: int):
        self.keys, self.length = keys, length
        self.bits = min(HEAD_BITS, 64 // length)
        self.shift = np.uint64(64 - self.bits * length)

    def of(self, places: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether the n-gram that ends ``at`` is so named, the numbers of those that are); ``places`` of tokens, -1 if not listed."""
        named, number = np.ones(len(at), dtype=bool), np.zeros(len(at), dtype=np.uint64)
        for j in range(self.length):
            p = places[at - j]
            named &= (p >= 0) & (p < 1 << self.bits)
            number |= p.astype(np.uint64) << np.uint64(j * self.bits)
        return named, (number[named] << self.shift) * _STEP

    def parts(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the n-grams' beginnings and endings."""
        number = (number * _UNSTEP) >> self.shift
        keys = [self.keys[(number >> np.uint64(j * self.bits)) & np.uint64((1 << self.bits) - 1)] for j in reversed(range(self.length))]
        while len(keys) > 2:
            keys = [joined_key(x, y) for x, y in zip(keys, keys[1:], strict=False)]
        return keys[0], keys[1]


def _planes(values: np.ndarray) -> bytes:
    """The values' bytes, all first ones before all second ones and so on: bytes that are mostly zero stand together, for the shuffle's compression."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplaned(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _count_grams(shared, head, parts: int) -> Callable:
    """Map function that counts the n-grams of the length after the filters' last.

    A row has n-grams whose last key falls in one of ``parts`` ranges, in binary columns (see `_planes`): named ones as
    differences of their numbers, others by their two parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, index = [b.value for b in shared], head.value
        named = Named(index.keys, len(filters) + 1)
        short, long = _Counter(1), _Counter(3)

        def rows(own: _Counter) -> Iterator[pa.RecordBatch]:
            some, cuts = _ranges(own.keys[-1], parts)
            keys, counts = [], []
            for i in some:
                at = slice(cuts[i], cuts[i + 1])
                if own is short:
                    keys.append(_planes(np.diff(own.keys[0][at] >> named.shift, prepend=np.uint64(0))))
                else:
                    keys.append(_planes(own.keys[0][at]) + _planes(own.keys[1][at]))
                counts.append(_planes(own.counts[at].astype(np.uint32)))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([own is short] * len(some), pa.bool_()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], names=["p", "named", "keys", "counts"])
            own.clear()

        for b in batches:
            for _, w in word_chunks(b.column(0)):
                tokens, place, _ = text_tokens(w)
                *_, (at, key, beginning, ending) = grams(tokens, place, filters)
                is_named, numbers = named.of(index.find(tokens), at)
                short.add([numbers])
                long.add([beginning[~is_named], ending[~is_named], key[~is_named]])
                for own in (short, long):
                    if len(own.counts) >= 2 * GATHER:
                        yield from rows(own)
        for own in (short, long):
            own.reduce()
            yield from rows(own)

    return run


def _sum_grams(head, length: int, min_count: int) -> Callable:
    """Map function that sums what `_count_grams` made, where all counts of an n-gram have met: (k, x, s, c) of those that are listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = Named(head.value.keys, length)
        held: dict[bool, list] = {True: [], False: []}
        for b in batches:
            for is_named, keys, counts in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if is_named:
                    own = [np.cumsum(_unplaned(keys, np.uint64), dtype=np.uint64) << named.shift]
                else:
                    own = [_unplaned(x, np.uint64) for x in (keys[: len(keys) // 2], keys[len(keys) // 2 :])]
                held[is_named].append([*own, _unplaned(counts, np.uint32).astype(np.int64)])
        for is_named, arrays in held.items():
            if not arrays:
                continue
            *keys, counts = [np.concatenate(x) for x in zip(*arrays, strict=True)]
            arrays.clear()
            key = keys[0] if is_named else joined_key(*keys)
            order = np.argsort(key)
            own = key[order]
            heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            total = np.add.reduceat(counts[order], heads)
            some = total >= min_count
            first, total = order[heads[some]], total[some]
            x, s = named.parts(key[first]) if is_named else (k[first] for k in keys)
            columns = [*(k.view(np.int64) for k in (joined_key(x, s), x, s)), total]
            for i in range(0, len(total), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 17)]) for c in columns], names=["k", "x", "s", "c"])

    return run


def _tested(counted: DataFrame, shorter: DataFrame) -> DataFrame:
    """(k, c, l, x, b, a) of one level's n-grams: ``l`` is L, ``b`` what the n-gram adds besides ``a``, the log of
    its context's share left to the parent; both null where the context isn't kept.  ``shorter``: k, c, l."""
    rows = counted.join(shorter.select(F.col("k").alias("s"), F.col("l").alias("parent")), "s").join(shorter.select(F.col("k").alias("x"), F.col("c").alias("n")), "x")
    rows = rows.withColumn("log_p", F.log((F.col("c") + PARENT_WEIGHT * F.exp("parent")) / (F.col("n") + PARENT_WEIGHT)))
    sums = rows.groupBy("x").agg(
        F.max("n").alias("n"), F.count(F.lit(1)).alias("listed"), F.sum("c").alias("stored"), F.sum(F.exp("parent")).alias("shared"), F.sum(F.col("c") * (F.col("log_p") - F.col("parent"))).alias("gain")
    )
    free = F.greatest(F.lit(1.0) - F.col("shared"), F.lit(1e-12))
    sums = sums.withColumn("a", F.log(F.greatest((F.col("n") - F.col("stored") + PARENT_WEIGHT * free) / (F.col("n") + PARENT_WEIGHT), F.lit(1e-12)) / free))
    gain = F.col("gain") + (F.col("n") - F.col("stored")) * F.col("a")
    kept = sums.where((gain >= LEAST_GAIN + NATS_PER_ENTRY * F.col("listed")) & (gain >= MIN_DIVERGENCE * F.col("n"))).select("x", "a")
    return rows.join(kept, "x", "left").select(
        "k", "c", F.when(F.col("a").isNotNull(), F.col("log_p")).otherwise(F.col("parent")).alias("l"), "x", (F.col("log_p") - F.col("parent") - F.col("a")).alias("b"), "a"
    )


@dataclass
class Learned:
    """Words (k, c, a), n-grams (k, c, w), the filters of the levels, and the corpus totals."""

    words: DataFrame
    grams: DataFrame
    filters: list
    tokens: int
    distinct: int


def learn(train: DataFrame, text: str = "text", depth: int = DEPTH, min_count: int = MIN_COUNT) -> Learned:
    """Learn the tree from every text of ``train``."""
    spark = train.sparkSession
    scratch = Scratch(spark, "lm")
    texts = train.select(quoted(text).alias("t"))
    words = scratch.table(texts.mapInArrow(_count_words, "k long, c long").groupBy("k").agg(F.sum("c").alias("c")))
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    z = total + ALPHA * (distinct + 1)
    levels = [words.where(F.col("c") >= min_count).withColumn("l", F.log((F.col("c") + F.lit(ALPHA)) / F.lit(z)))]
    filters = []
    top = words.where(_head(words, min(HEAD_WORDS, 1 << HEAD_BITS))).toArrow()  # 1 << HEAD_BITS rows at most
    named = spark.sparkContext.broadcast(HashIndex(top.column("k").to_numpy().view(np.uint64)[np.argsort(-top.column("c").to_numpy(), kind="stable")]))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TASK_TOKENS)
    for length in range(2, depth + 2):
        filters.append(spark.sparkContext.broadcast(Bitmap.of(levels[-1])))
        counted = texts.mapInArrow(_count_grams(list(filters), named, parts), "p int, named boolean, keys binary, counts binary").repartitionById(parts, "p")
        counted = scratch.table(counted.mapInArrow(_sum_grams(named, length, min_count), "k long, x long, s long, c long"))
        levels.append(scratch.table(_tested(counted, levels[-1].select("k", "c", "l"))))
        scratch.drop(scratch.made - 2, scratch.made - 1)
    # what an n-gram adds as a context of the next token is part of its weight
    contexts = [level.where("a IS NOT NULL").select(F.col("x").alias("k"), "a").distinct() for level in levels[1:]]
    weights = None
    for i, level in enumerate(levels[1:]):
        own = level.select("k", "c", F.coalesce("b", F.lit(0.0)).alias("b"))
        if i + 1 < len(contexts):
            own = own.join(contexts[i + 1], "k", "left").select("k", "c", (F.col("b") + F.coalesce("a", F.lit(0.0))).alias("b"))
        own = own.where("b != 0").select("k", "c", F.col("b").alias("w"))
        weights = own if weights is None else weights.unionByName(own)
    named = words.join(contexts[0], "k", "left").select("k", "c", F.coalesce("a", F.lit(0.0)).alias("a")) if contexts else words.withColumn("a", F.lit(0.0))
    named = scratch.table(named)
    weights = scratch.table(weights if weights is not None else named.where("false").select("k", "c", F.col("a").alias("w")))
    scratch.drop(0, scratch.made - 2)
    return Learned(named, weights, filters, total, distinct)


def _head(table: DataFrame, room: int) -> Column:
    """A condition that holds for about the ``room`` rows of highest count, and for no more."""
    steps = table.groupBy(F.floor(F.log2(F.col("c").cast("double")) * 16).alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()
    least = None
    for r in sorted(steps, key=lambda r: -r["step"]):
        room -= r["n"]
        if room < 0:
            break
        least = r["least"]
    return F.lit(False) if least is None else F.col("c") >= least


def is_held_out(doc_id: Column, folds: int = 10) -> Column:
    """Whether crc32 of the id as text is divisible by ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def _ranges(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(ranges, of ``parts``, that have some of the sorted ``keys``; where all ranges begin and end)."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
    return np.flatnonzero(cuts[1:] > cuts[:-1]), cuts


#: Keys asked by rows (``first``: the lowest row; rows and times: see `_Asked`), or tables of keys (``first`` is null, ``rows`` their values).
_PACKED = "p int, kind int, first long, keys binary, rows binary, times binary"


class _Asked:
    """Keys that the rows of a task ask for, about ``2 * GATHER`` at a time, packed by ranges of keys."""

    def __init__(self, kind: int, parts: int):
        self.kind, self.parts, self.keys, self.rows, self.held = kind, parts, [], [], 0

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        self.keys.append(keys)
        self.rows.append(rows)
        self.held += len(keys)

    def packed(self) -> list[tuple]:
        if not self.held:
            return []
        keys, rows = np.concatenate(self.keys), np.concatenate(self.rows)
        self.keys, self.rows, self.held = [], [], 0
        order = _packed_order(keys)
        keys, rows = keys[order], rows[order]
        heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])))
        times = np.diff(np.append(heads, len(keys))).astype(np.uint32)
        keys, rows, first = keys[heads], rows[heads], int(rows.min())
        some, cuts = _ranges(keys, self.parts)
        out = []
        for i in some:
            at = slice(cuts[i], cuts[i + 1])
            out.append((int(i), self.kind, first, _planes(np.diff(keys[at], prepend=np.uint64(0))), _planes((rows[at] - first).astype(np.uint32)), _planes(times[at])))
        return out


def _packed_table(table: DataFrame, kind: int, parts: int) -> DataFrame:
    """Rows (k, doubles) of a table, packed by ranges of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            order = np.argsort(k)
            k, values = k[order], [b.column(i).to_numpy(zero_copy_only=False)[order] for i in range(1, b.num_columns)]
            some, cuts = _ranges(k, parts)
            ats = [slice(cuts[i], cuts[i + 1]) for i in some]
            keys, packed = [k[at].tobytes() for at in ats], [b"".join(v[at].tobytes() for v in values) for at in ats]
            yield _packed_batch([(int(i), kind, None, x, y, None) for i, x, y in zip(some, keys, packed, strict=True)])

    return table.mapInArrow(run, _PACKED)


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["p", "kind", "first", "keys", "rows", "times"])


def _answers(z: float, parts: int) -> Callable:
    """Map function over asked keys and tables of one range: row, known, base and more, summed by row as far as they meet here, packed by ranges of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, asked = {0: [], 1: []}, []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[2] is None:
                    keys = np.frombuffer(r[3], np.uint64)
                    tables[r[1]].append((keys, np.frombuffer(r[4], np.float64).reshape(-1, len(keys))))
                else:
                    asked.append(r)
        found = {}
        for kind, width in ((0, 2), (1, 1)):
            own = tables.pop(kind)
            # the last place is for keys that aren't in the table
            found[kind] = HashIndex(np.concatenate([k for k, _ in own] or [np.zeros(0, np.uint64)])), np.concatenate([*(v for _, v in own), np.zeros((width, 1))], axis=1)
        sums = [[], [], [], []]
        for _, kind, first, keys, rows, times in asked:
            index, values = found[kind]
            at, m = index.find(np.cumsum(_unplaned(keys, np.uint64), dtype=np.uint64)), _unplaned(times, np.uint32).astype(np.int64)
            row, none = _unplaned(rows, np.uint32).astype(np.int64) + first, np.zeros(len(m))
            if kind == 0:
                own = [row, m * (at >= 0), m * np.log((values[0][at] + ALPHA) / z), m * values[1][at]]
            else:
                some = at >= 0
                own = [row[some], none[some].astype(np.int64), none[some], (m * values[0][at])[some]]
            for to, x in zip(sums, own, strict=True):
                to.append(x)
        if asked:
            row, known, base, more = _by_row(*(np.concatenate(x) for x in sums))
            block = mix64((row >> ROW_BLOCK).astype(np.uint64))
            order = np.argsort(block, kind="stable")  # rows of a block stay in order
            some, cuts = _ranges(block[order], parts)
            rows = []
            for i in some:
                at = order[cuts[i] : cuts[i + 1]]
                rows.append((int(i), 2, None, _planes(np.diff(row[at], prepend=np.int64(0))), _planes(known[at]) + _planes(base[at]), _planes(more[at])))
            yield _packed_batch(rows)

    return run


def _by_row(row: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The distinct rows in order, and the values summed by them."""
    order = np.argsort(row, kind="stable")
    row = row[order]
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    return [row[heads], *(np.add.reduceat(x[order], heads) if len(heads) else x for x in values)]


def _sum_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, known, base, more) of packed answers, summed by row; all answers to a row have met here."""
    held = [[], [], [], []]
    for b in batches:
        for keys, rows, more in zip(*(b.column(i).to_pylist() for i in (3, 4, 5)), strict=True):
            half = len(rows) // 2
            for to, x in zip(held, (np.cumsum(_unplaned(keys, np.int64)), _unplaned(rows[:half], np.int64), _unplaned(rows[half:], np.float64), _unplaned(more, np.float64)), strict=True):
                to.append(x)
    if held[0]:
        columns = _by_row(*(np.concatenate(x) for x in held))
        for i in range(0, len(columns[0]), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 17)]) for c in columns], names=["__tm_row", "__tm_known2", "__tm_base2", "__tm_more2"])


def lm_scores(df: DataFrame, train: DataFrame, text: str = "text", depth: int = DEPTH, min_count: int = MIN_COUNT, keep: list[str] | None = None) -> DataFrame:
    """``df`` (its columns ``keep``, else all) with n_tokens, n_known, train_tokens, base_score and score (log10)."""
    outputs = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    spark = df.sparkSession
    learned = learn(train, text, depth, min_count)
    z = learned.tokens + ALPHA * (learned.distinct + 1)
    in_words, in_grams = _head(learned.words, HEAD_WORDS), _head(learned.grams, HEAD_GRAMS)
    top = learned.words.where(in_words).select("k", F.col("c").cast("double").alias("c"), "a").toArrow()  # HEAD_WORDS rows at most
    named = HashIndex(top.column("k").to_numpy().view(np.uint64)), np.log((top.column("c").to_numpy() + ALPHA) / z), top.column("a").to_numpy()
    top = learned.grams.where(in_grams).select("k", "w").toArrow()  # HEAD_GRAMS rows at most
    weighed = HashIndex(top.column("k").to_numpy().view(np.uint64)), top.column("w").to_numpy()
    rest = learned.grams.where(~in_grams)
    shared = spark.sparkContext.broadcast((named, weighed, Bitmap.of(rest)))
    filters = learned.filters

    keep = [c for c in without(df, outputs).columns if keep is None or c in keep]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = df.select(quoted(text).alias("text"), F.monotonically_increasing_id().alias("row"), *[quoted(c).alias(f"keep{i}") for i, c in enumerate(keep)])
    figures = {"n": T.LongType(), "known": T.LongType(), "base": T.DoubleType(), "more": T.DoubleType()}
    packed = T.StructType.fromDDL(_PACKED)
    schema = T.StructType([T.StructField("row", T.LongType()), *[T.StructField(f"keep{i}", df.schema[c].dataType) for i, c in enumerate(keep)], *[T.StructField(n, t) for n, t in figures.items()], *packed.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, and rows with what they ask for, whose other columns are null."""
        arrow = to_arrow_schema(schema)
        (index, root, as_context), (gram_index, gram_weight), others = shared.value
        listed = [b.value for b in filters]
        words, rare_grams = _Asked(0, parts), _Asked(1, parts)

        def texts(kept: list[pa.Array], own: list[pa.Array]) -> pa.RecordBatch:
            nothing = [pa.nulls(len(own[0]), f.type) for f in list(arrow)[-len(packed) :]]
            columns = [*kept, *own, *nothing]
            return pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(columns, arrow, strict=True)], schema=arrow)

        def asks(own: _Asked) -> Iterator[pa.RecordBatch]:
            if rows := own.packed():
                b = _packed_batch(rows)
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(rows), f.type) for f in list(arrow)[: -len(packed)]), *b.columns], schema=arrow)

        for b in batches:
            for rows, w in word_chunks(b.column(0)):
                tokens, place, bounds = text_tokens(w)
                ids = b.column(1).to_numpy(zero_copy_only=False)[rows]
                row_of = lambda at: ids[np.searchsorted(bounds, at, side="right") - 1]  # noqa: B023, E731
                found = index.find(tokens)
                known = found >= 0
                base, more = np.zeros(len(tokens)), np.zeros(len(tokens))
                base[known] = root[found[known]]
                more[known] = as_context[found[known]]
                for at, key, _, _ in grams(tokens, place, listed):
                    got = gram_index.find(key)
                    more[at[got >= 0]] += gram_weight[got[got >= 0]]
                    unsure = (got < 0) & others.may_hold(key)
                    rare_grams.add(key[unsure], row_of(at[unsure]))
                rare = np.flatnonzero(~known)
                words.add(tokens[rare], row_of(rare))
                start, stop, _ = rows.indices(b.num_rows)
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (known.astype(np.int64), base, more)]
                yield texts([b.column(i).slice(start, stop - start) for i in range(1, b.num_columns)], [pa.array(x) for x in (np.diff(bounds), *sums)])
                for own in (words, rare_grams):
                    if own.held >= 2 * GATHER:
                        yield from asks(own)
        for own in (words, rare_grams):
            yield from asks(own)

    both = Scratch(spark, "lm-rows").table(sent.mapInArrow(run, schema))
    rows = both.where("p IS NULL").select(*[F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)], F.col("row").alias("__tm_row"), *[F.col(n).alias(f"__tm_{n}") for n in figures])
    tables = _packed_table(learned.words.where(~in_words).select("k", F.col("c").cast("double"), "a"), 0, parts).unionByName(_packed_table(rest.select("k", "w"), 1, parts))
    # a row per text and distinct key: a word that no table holds can be frequent
    met = both.where("p IS NOT NULL").select(*packed.names).unionByName(tables).repartitionById(parts, "p")
    answers = met.mapInArrow(_answers(z, parts), _PACKED).repartitionById(parts, "p")
    sums = answers.mapInArrow(_sum_answers, "__tm_row long, __tm_known2 long, __tm_base2 double, __tm_more2 double")
    plus = lambda a, b, zero: F.col(a) + F.coalesce(b, F.lit(zero))
    base = plus("__tm_base", "__tm_base2", 0.0)
    return rows.join(sums, "__tm_row", "left").select(
        *[quoted(c) for c in keep],
        F.col("__tm_n").alias("n_tokens"),
        plus("__tm_known", "__tm_known2", 0).cast("long").alias("n_known"),
        F.lit(learned.tokens).cast("long").alias("train_tokens"),
        (base / math.log(10)).alias("base_score"),
        ((base + plus("__tm_more", "__tm_more2", 0.0)) / math.log(10)).alias("score"),
    )


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_scores(docs, docs.where(~is_held_out(F.col("doc_id"))), keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
