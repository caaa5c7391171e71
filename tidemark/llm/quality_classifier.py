"""Quality by ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = logistic(threshold[k] - w.x)``: one weight vector over hashed text for all grades, and
ordered thresholds.  It gives each text an expected grade and the probability of a grade of at
least ``tail_grade``, on which texts are selected.

The representation is hashed into ``DIMENSIONS`` buckets: byte trigrams of the whole text (digits alike),
damped by a logarithm and scaled to length 1, and, in buckets of their own, the shares of
distinct words and of distinct word pairs and the order of magnitude of the length.

Training texts are a bounded, documented sample of the rated rows (`SAMPLE` per grade, by a hash of
the id); everything else covers all rows.  The weights' size is fixed, so they are broadcast.

Defined cases: null texts and texts without words have expected grade 0 and tail probability 0;
equal texts get equal results and every row stays; rows whose id is null are scored and not learned
from; several ratings for an id count as the lowest; with fewer than two grades every text gets the one
there is (0 without ratings); input columns named like an output column are replaced, others are passed
through; texts of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, quoted, read_table, without
from .textnum import ROW_BITS, Words, mix64, text_buffer, words_of

BITS = 16
SHAPES = 64
DIMENSIONS = (1 << BITS) + SHAPES
SAMPLE = 2500
STEPS, RATE, RIDGE = 120, 0.5, 1e-6
_CHUNK = 1 << 19
_CODE = np.arange(256, dtype=np.uint32)
_CODE[48:58] = 48  # digits alike


@dataclass
class Features:
    """Sparse rows: ``index`` and ``value`` of row r stand at ``bounds[r]:bounds[r + 1]``."""

    index: np.ndarray
    value: np.ndarray
    bounds: np.ndarray
    words: np.ndarray


def _share(words: Words, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Distinct keys of each row as a share of its keys; 1 where it has none."""
    rows = len(counts)
    row = np.repeat(np.arange(rows, dtype=np.uint64), counts)
    own = np.sort((row << np.uint64(64 - ROW_BITS)) | (keys >> np.uint64(ROW_BITS)))
    if not len(own):
        return np.ones(rows)
    fresh = own[np.append(True, own[1:] != own[:-1])] >> np.uint64(64 - ROW_BITS)
    return np.where(counts > 0, np.bincount(fresh.astype(np.int64), minlength=rows) / np.maximum(counts, 1), 1.0)


def features(data: np.ndarray, offsets: np.ndarray) -> Features:
    """Representations of rows given as one byte buffer with row offsets."""
    rows = len(offsets) - 1
    words = words_of(data, offsets)
    n_words = words.counts
    size = np.diff(offsets)
    code = _CODE[data]
    gram = (code[:-2] | code[1:-1] << np.uint32(8) | code[2:] << np.uint32(16)) if len(code) > 2 else np.zeros(0, np.uint32)
    hashed = (gram * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    row = np.repeat(np.arange(rows), size)[: len(gram)]
    inside = np.arange(len(gram)) + 2 < offsets[1:][row]
    key = np.sort((row[inside].astype(np.uint64) << np.uint64(BITS)) | hashed[inside])
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(heads, len(key)))
    key = key[heads]
    row, index = (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=rows))
    value = value / np.maximum(norm, 1e-12)[row]
    pairs = np.maximum(n_words - 1, 0)
    at = np.repeat(words.bounds[:-1], pairs) + np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    shapes = [
        np.minimum(9, (10 * _share(words, words.hashes, n_words)).astype(np.int64)),
        10 + np.minimum(9, (10 * _share(words, mix64(words.hashes[at]) + words.hashes[at + 1] if len(at) else words.hashes[:0], pairs)).astype(np.int64)),
        20 + np.minimum(30, np.log2(n_words + 1).astype(np.int64)),
    ]
    everyone = np.arange(rows)
    row = np.concatenate([row, *[everyone] * 3])
    index = np.concatenate([index, *[(1 << BITS) + s for s in shapes]])
    value = np.concatenate([value, np.full(3 * rows, 0.3)])
    order = np.argsort(row, kind="stable")
    return Features(index[order], value[order], np.searchsorted(row[order], np.arange(rows + 1)), n_words)


def feature_chunks(array: pa.Array):
    """(rows, features) of an Arrow string array in slices of whole rows."""
    data, offsets = text_buffer(array)
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + _CHUNK, side="right")) - 1
        stop = min(max(stop, start + 1), rows, start + (1 << ROW_BITS))
        part = offsets[start : stop + 1]
        yield slice(start, stop), features(data[part[0] : part[-1]], part - part[0])
        start = stop


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    """Shared weights and ordered thresholds for grades 0 to len(thresholds)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, strength: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., by columns."""
        return logistic(strength[:, None] - self.thresholds[None, :])

    def strength(self, f: Features) -> np.ndarray:
        return _row_sums(f.value * self.weights[f.index], f.bounds)


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each row, whatever its neighbours are; every row has its shape features, so none is empty."""
    return np.add.reduceat(values, bounds[:-1]) if len(values) else np.zeros(len(bounds) - 1)


def objective(f: Features, grade: np.ndarray, weights: np.ndarray, base: np.ndarray, gaps: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood with the ridge, and its gradients by weights and by (base, gaps).

    Thresholds are ``base`` and then ``base`` plus the running sum of exp(gaps).
    """
    n, grades = len(grade), len(gaps) + 2
    cuts = np.concatenate([base, base + np.cumsum(np.exp(gaps))])
    strength = _row_sums(f.value * weights[f.index], f.bounds)
    edges = np.concatenate([[-np.inf], cuts, [np.inf]])
    high = np.where(grade == grades - 1, 1.0, logistic(edges[np.minimum(grade + 1, grades - 1)] - strength))
    low = np.where(grade == 0, 0.0, logistic(edges[np.maximum(grade, 1)] - strength))
    p = np.maximum(high - low, 1e-12)
    dh, dl = high * (1 - high) / p, low * (1 - low) / p
    row = np.repeat(np.arange(n), np.diff(f.bounds))
    g_weights = np.bincount(f.index, weights=f.value * ((dh - dl) / n)[row], minlength=DIMENSIONS) + RIDGE * weights
    g_cuts = np.array([-dh[grade == k].sum() + dl[grade == k + 1].sum() for k in range(grades - 1)]) / n
    tail = np.cumsum(g_cuts[::-1])[::-1]
    return -np.log(p).mean() + 0.5 * RIDGE * weights @ weights, g_weights, np.concatenate([tail[:1], tail[1:] * np.exp(gaps)])


def fit_ordinal(f: Features, grade: np.ndarray, grades: int) -> Ordinal:
    """Maximum likelihood with a small ridge, by adaptive gradient steps over all rows."""
    weights = np.zeros(DIMENSIONS)
    # thresholds start at the grades' own frequencies; gaps stay positive as exponentials
    below = np.clip(np.array([(grade <= k).mean() for k in range(grades - 1)]), 0.01, 0.99)
    start = np.log(below / (1 - below))
    start = np.maximum.accumulate(start + 1e-3 * np.arange(grades - 1))
    base, gaps = start[:1].copy(), np.log(np.maximum(np.diff(start), 1e-3))
    moments = [np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), np.zeros(grades - 1), np.zeros(grades - 1)]
    for step in range(1, STEPS + 1):
        _, g_weights, g_shape = objective(f, grade, weights, base, gaps)
        for g, m, v, put in ((g_weights, 0, 1, "w"), (g_shape, 2, 3, "c")):
            moments[m] = 0.9 * moments[m] + 0.1 * g
            moments[v] = 0.99 * moments[v] + 0.01 * g * g
            move = RATE * (1 - step / (STEPS + 1)) * (moments[m] / (1 - 0.9**step)) / (np.sqrt(moments[v] / (1 - 0.99**step)) + 1e-8)
            if put == "w":
                weights = weights - move
            else:
                base, gaps = base - 0.2 * move[:1], gaps - 0.2 * move[1:]
    return Ordinal(weights, np.concatenate([base, base + np.cumsum(np.exp(gaps))]))


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text: str = "text", grade: str = "grade", per_grade: int = SAMPLE) -> Ordinal | int:
    """Learn from rated texts; the only grade where ratings have one, 0 where there are none."""
    one = ratings.where(quoted(id_col).isNotNull() & quoted(grade).isNotNull()).groupBy(quoted(id_col).alias("s_id")).agg(F.min(quoted(grade).cast("int")).alias("y"))
    found = sorted(r["y"] for r in one.select("y").distinct().collect())
    if len(found) < 2:
        return found[0] if found else 0
    sample = None
    for y in found:
        part = one.where(F.col("y") == y).orderBy(F.xxhash64("s_id"), "s_id").limit(per_grade)
        sample = part if sample is None else sample.unionByName(part)
    # the sample's size is bounded above, so it can go to every task
    texts = docs.select(quoted(id_col).alias("s_id"), quoted(text).alias("text")).join(F.broadcast(sample), "s_id").select("text", "y")

    def represent(batches):
        for b in batches:
            for rows, f in feature_chunks(b.column(0)):
                bounds = pa.array(f.bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(rows.start, len(f.words)), pa.ListArray.from_arrays(bounds, pa.array(f.index.astype(np.int32))), pa.ListArray.from_arrays(bounds, pa.array(f.value.astype(np.float32)))],
                    names=["y", "i", "v"],
                )

    table = texts.mapInArrow(represent, "y int, i array<int>, v array<float>").toArrow()
    lists = table.column("i").combine_chunks()
    y = table.column("y").to_numpy()
    if len(np.unique(y)) < 2:
        return int(y[0]) if len(y) else 0
    lengths = pa.compute.list_value_length(lists).to_numpy()
    f = Features(lists.flatten().to_numpy().astype(np.int64), table.column("v").combine_chunks().flatten().to_numpy().astype(float), np.concatenate([[0], np.cumsum(lengths)]), lengths)
    return fit_ordinal(f, y.astype(np.int64), max(found) + 1)


def grade_texts(df: DataFrame, model: Ordinal | int, text: str = "text", tail_grade: int = 1) -> DataFrame:
    """``df`` with expected_grade and tail_probability."""
    names = ["expected_grade", "tail_probability"]
    keep = without(df, names).columns
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for (array,) in batches:
            for rows, f in feature_chunks(array):
                some = f.words > 0
                if isinstance(own, int):
                    expected, tail = np.where(some, float(own), 0.0), np.where(some & (own >= tail_grade), 1.0, 0.0)
                else:
                    reach = own.at_least(own.strength(f))
                    expected = np.where(some, reach.sum(axis=1), 0.0)
                    tail = np.where(some, reach[:, tail_grade - 1] if tail_grade <= reach.shape[1] else 0.0, 0.0)
                yield rows, [pa.array(expected), pa.array(tail)]

    return arrow_map(df, [quoted(text)], keep, [T.StructField(n, T.DoubleType()) for n in names], run)


def graded(labels: DataFrame) -> DataFrame:
    """Ratings from the labels: 0 poor, 1 well-formed but toxic, 2 well-formed and clean."""
    grade: Column = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where("quality is not null").select("doc_id", grade.alias("grade"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    ratings = graded(read_table(spark, sf_dir, "labels").where(fold != 0))
    made = grade_texts(docs, fit(docs, ratings))
    return made.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "expected_grade", "tail_probability", (F.col("tail_probability") >= 0.5).alias("kept"))
