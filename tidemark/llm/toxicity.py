"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Units are the stretches of a text without white space (lower-cased, outer punctuation cut off) and
runs of single characters joined.  The subsequence kernel of two units counts
every common subsequence of three characters with a factor ``DECAY`` for each character it
spans in either unit, normalised to 1 for equal units, so inserted characters cost little; its power ``SHARPNESS``,
a kernel too, tells a unit from those that only share some of its parts.  Landmarks
are units that mark toxic training texts, no two of them alike, and some common ones.  A text's
representation is its best kernel value with each landmark (subsequence kernels below ``FLOOR`` count 0), mapped by
the inverse root of the landmarks' own kernel matrix (Nyström); a linear support vector machine on
it is fitted with squared hinge loss and calibrated to (0, 1) on texts that its fit left out.

Most units are like no landmark, which a bound shows without their kernels: the subsequences that hold most of a
landmark's norm are indexed, the rest of it adds its norm at most (Cauchy-Schwarz), and a unit's own
norm is least when its characters differ.  Only pairs whose bound reaches ``FLOOR`` are computed.  Units over
``WINDOW`` characters are covered by windows, so close that each stretch of ``LONGEST`` characters lies in one; a unit
with inner punctuation is also compared without it.  Units seen are cached, in bounded space.  What is learned of a unit
of more than ``LONGEST`` characters are its stretches of that length, each a landmark like any other, so insults may be of any length.

Training texts are a bounded, documented sample of the labelled rows (`TOXIC_SAMPLE`, `CLEAN_SAMPLE`, by a
hash of the id); everything else covers all rows.

Defined cases: null and empty texts have no units and get the score of an all-zero
representation; equal texts get equal scores and every row stays; ids that are null are scored and
never learned from; several labels for an id count as toxic if one is; with no labels of either
kind every score is 0; input columns named like an output column are replaced, others are passed
through; texts of any length are scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, quoted, read_table, slices, without
from .vocab import TwoGenerations

ORDER = 3
DECAY = 0.6
#: Landmarks have at most LONGEST characters.
WINDOW, LONGEST = 16, 12
STRIDE = WINDOW - LONGEST + 1
FLOOR = 0.6
SHARPNESS = 8
#: The part of a landmark's norm that is not indexed.
RESIDUAL = 0.3
LANDMARKS, COMMON = 256, 8
#: Subsequence kernels of two landmarks are below this.
ALIKE = 0.9
PENALTY = 0.1
#: Nats by which a marking unit's toxic texts exceed what the base rate explains.
EVIDENCE = 8.0
#: Parts of the sample, each left out once to calibrate; toxic rows weigh (clean / toxic) ** BALANCE there.
CALIBRATION_FOLDS = 4
BALANCE = 0.5
TOXIC_SAMPLE, CLEAN_SAMPLE = 4000, 12000
CANDIDATES = 3000
SLICE_CHARS = 1 << 20
_OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_SPELLED = re.compile(r"(?<!\S)(?:\S[ \t]{1,3}){2,}\S(?!\S)")


def unit_of(chunk: str) -> str:
    return chunk.lower().strip(_OUTER)


def chunks_of(text: str) -> list[str]:
    """Distinct stretches of a text, and its spelled-out words joined."""
    out = set(text.split())
    for run in _SPELLED.findall(text):
        out.add("".join(run.split()))
    return list(out)


def windows(unit: str) -> list[str]:
    """The strings a unit is compared by: itself, or windows that cover it, and the same without inner punctuation."""
    if not unit.isalnum():
        bare = "".join(c for c in unit if c.isalnum())
        if ORDER <= len(bare) < len(unit):
            return [*_cover(unit), *_cover(bare)]
    return _cover(unit)


def _cover(unit: str) -> list[str]:
    if len(unit) <= WINDOW:
        return [unit]
    return [unit[i : i + WINDOW] for i in range(0, len(unit) - WINDOW + STRIDE, STRIDE)]


def learned_from(unit: str) -> list[str]:
    """What can become a landmark of a unit: itself, or of a longer one all its stretches of ``LONGEST`` characters."""
    if len(unit) <= LONGEST:
        return [unit] if len(unit) >= ORDER else []
    return [unit[i : i + LONGEST] for i in range(len(unit) - LONGEST + 1)]


def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the subsequences of ``n`` characters and their factors."""
    places = np.array(list(combinations(range(n), 3)))
    return places, (DECAY ** (places[:, 2] - places[:, 0] + 1)).astype(np.float32)


def self_kernel(codes: np.ndarray) -> np.ndarray:
    """K(s, s) of units of one length, given as rows of character codes."""
    rows, n = codes.shape
    same = codes[:, :, None] == codes[:, None, :]
    d2 = DECAY * DECAY
    prefix = np.ones((rows, n + 1, n + 1))
    for _ in range(ORDER - 1):
        now = np.zeros((rows, n + 1, n + 1))
        for a in range(1, n + 1):
            run = np.zeros(rows)
            for b in range(1, n + 1):
                run = DECAY * run + d2 * np.where(same[:, a - 1, b - 1], prefix[:, a - 1, b - 1], 0.0)
                now[:, a, b] = DECAY * now[:, a - 1, b] + run
        prefix = now
    return d2 * np.where(same, prefix[:, :-1, :-1], 0.0).sum(axis=(1, 2))


class Landmarks:
    """The kernel of any unit with fixed landmarks."""

    def __init__(self, units: list[str]):
        self.units = units
        letters = sorted({c for u in units for c in u})
        self.codes = {c: i + 1 for i, c in enumerate(letters)}
        base = len(letters) + 1
        self.base = base
        triples, weights, indexed = [], [], []
        for u in units:
            own = np.array([self.codes[c] for c in u], dtype=np.int64)
            places, factor = _triples(len(u))
            mine, where = np.unique((own[places[:, 0]] * base + own[places[:, 1]]) * base + own[places[:, 2]], return_inverse=True)
            weight = np.bincount(where, weights=factor) / np.sqrt(self_kernel(np.array([[ord(c) for c in u]]))[0])
            order = np.argsort(-weight, kind="stable")
            mass = weight[order] ** 2
            triples.append(mine)
            weights.append(weight)
            indexed.append(order[: int(np.searchsorted(np.cumsum(mass), mass.sum() * (1 - RESIDUAL**2))) + 1])
        #: number of each triple of letters that some landmark has, 0 for the others
        self.number = np.zeros(base**3, dtype=np.int32)
        used = np.unique(np.concatenate(triples)) if triples else np.zeros(0, np.int64)
        self.number[used] = np.arange(1, len(used) + 1)
        #: by number, its weight in each landmark, for landmarks of norm 1
        self.weights = np.zeros((len(used) + 1, len(units)), dtype=np.float32)
        for j, (mine, weight) in enumerate(zip(triples, weights, strict=True)):
            self.weights[self.number[mine], j] = weight
        tops = [self.number[mine[top]] for mine, top in zip(triples, indexed, strict=True)]
        rows, marks = (np.concatenate(x) if units else np.zeros(0, np.int64) for x in (tops, [np.full(len(t), j) for j, t in enumerate(tops)]))
        order = np.argsort(rows, kind="stable")
        rows, self.index = rows[order], marks[order]
        self.starts = np.searchsorted(rows, np.arange(len(used) + 2))
        self.index_weight = self.weights[rows, self.index]

    def __reduce__(self):
        return Landmarks, (self.units,)

    def _keys(self, units: list[str], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(character codes, triples' numbers) of units of one length."""
        raw = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(units), -1).astype(np.int64)
        table = np.zeros(int(raw.max()) + 1, dtype=np.int64)
        for c, k in self.codes.items():
            if ord(c) < len(table):
                table[ord(c)] = k
        code = table[raw]
        one, two, three = (code[:, places[:, i]] for i in range(3))
        # a letter that no landmark has is 0, and so is the number of every triple with one
        return raw, self.number[(one * self.base + two) * self.base + three]

    @staticmethod
    def _by_length(units: list[str]) -> Iterator[tuple[int, list[int]]]:
        """Numbers of units of one length, at most 2,048 at once."""
        groups: dict[int, list[int]] = {}
        for i, u in enumerate(units):
            if len(u) >= ORDER:
                groups.setdefault(len(u), []).append(i)
        for n, members in groups.items():
            for cut in range(0, len(members), 2048):
                yield n, members[cut : cut + 2048]

    def kernel(self, units: list[str]) -> np.ndarray:
        """Subsequence kernel of units (each at most WINDOW characters) with every landmark."""
        out = np.zeros((len(units), len(self.units)), dtype=np.float32)
        for n, own in self._by_length(units):
            places, factor = _triples(n)
            raw, key = self._keys([units[i] for i in own], places)
            step = max(1, (1 << 22) // (key.shape[1] * max(1, len(self.units))))
            raws = [np.einsum("j,ijk->ik", factor, self.weights[key[k : k + step]]) for k in range(0, len(own), step)]
            out[own] = np.concatenate(raws) / np.sqrt(self_kernel(raw))[:, None].astype(np.float32)
        return out

    def near(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit, landmark, subsequence kernel) of all pairs whose kernel is ``FLOOR`` or more."""
        width, found = len(self.units), []
        for n, own in self._by_length(units):
            places, factor = _triples(n)
            raw, key = self._keys([units[i] for i in own], places)
            row, col = np.nonzero(self.starts[key + 1] > self.starts[key])
            at = key[row, col]
            many = self.starts[at + 1] - self.starts[at]
            entry = np.repeat(self.starts[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
            pair = np.repeat(row, many) * width + self.index[entry]
            held = np.bincount(pair, weights=np.repeat(factor[col], many) * self.index_weight[entry], minlength=0)
            pair = np.flatnonzero(held >= (FLOOR - RESIDUAL) * np.sqrt((factor.astype(float) ** 2).sum()) - 1e-6)
            if not len(pair):
                continue
            unit, mark = pair // width, pair % width
            some = np.unique(unit)
            norm = np.ones(len(own))
            norm[some] = np.sqrt(self_kernel(raw[some]))
            for cut in range(0, len(pair), 4096):
                u, m = unit[cut : cut + 4096], mark[cut : cut + 4096]
                value = (self.weights[key[u], m[:, None]] @ factor) / norm[u]
                good = value >= FLOOR
                found.append((np.array(own)[u[good]], m[good], value[good]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def chunk_values(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """(landmarks, kernel values) of each chunk; None where it is like no landmark."""
        parts, owner = [], []
        for i, c in enumerate(chunks):
            for w in windows(unit_of(c)):
                parts.append(w)
                owner.append(i)
        unit, mark, value = self.near(parts)
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(chunks)
        if len(unit):
            chunk = np.array(owner)[unit]
            order = np.argsort(chunk, kind="stable")
            chunk, mark, value = chunk[order], mark[order], value[order].astype(np.float32) ** SHARPNESS
            heads = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
            for lo, hi in zip(heads, np.append(heads[1:], len(chunk)), strict=True):
                out[chunk[lo]] = mark[lo:hi].astype(np.int16), value[lo:hi]
        return out


def text_values(texts: list[str | None], landmarks: Landmarks, cache: TwoGenerations) -> np.ndarray:
    """Each text's best kernel value with every landmark."""
    rows = [chunks_of(t) if t else [] for t in texts]
    fresh = cache.missing(c for row in rows for c in row)
    for i in range(0, len(fresh), 50_000):
        part = fresh[i : i + 50_000]
        # False stands for a chunk like no landmark
        cache.young.update(zip(part, [False if v is None else v for v in landmarks.chunk_values(part)], strict=True))
    known = cache.young
    out = np.zeros((len(rows), len(landmarks.units)), dtype=np.float32)
    for r, row in enumerate(rows):
        for v in map(known.__getitem__, row):
            if v is not False:
                np.maximum.at(out[r], v[0], v[1])
    return out


@dataclass
class Machine:
    """A fitted model."""

    landmarks: Landmarks
    mapping: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, values: np.ndarray) -> np.ndarray:
        margin = values @ self.mapping @ self.weights + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss and balanced classes, by Newton steps.  y: -1 or 1."""
    n = len(y)
    full = np.hstack([x, np.ones((n, 1))])
    cost = penalty * np.where(y > 0, n / (2 * max(1, (y > 0).sum())), n / (2 * max(1, (y < 0).sum())))
    ridge = np.eye(full.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(full.shape[1])

    def loss(v: np.ndarray) -> float:
        return 0.5 * v @ ridge @ v + (cost * np.maximum(0, 1 - y * (full @ v)) ** 2).sum()

    for _ in range(50):
        gap = np.maximum(0, 1 - y * (full @ w))
        active = gap > 0
        grad = ridge @ w - 2 * full.T @ (cost * y * gap)
        hess = ridge + 2 * (full[active] * cost[active][:, None]).T @ full[active]
        step = np.linalg.solve(hess, grad)
        size, here = 1.0, loss(w)
        while loss(w - size * step) > here and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through smoothed targets, by Newton steps."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(y > 0, (neg / pos) ** BALANCE, 1.0)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))
        g = weight * (p - target)
        v = weight * p * (1 - p) + 1e-12
        grad = np.array([(g * margin).sum() + 1e-3 * a, g.sum()])
        hess = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a, 1e-3)), float(b)


def margins_left_out(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Each row's margin by a machine that was fitted without it (and without its part of the sample)."""
    part = np.zeros(len(y), dtype=np.int64)
    for kind in (y > 0, y < 0):  # every part has its share of either label
        part[np.flatnonzero(kind)] = np.arange(kind.sum()) % CALIBRATION_FOLDS
    out = np.zeros(len(y))
    for k in range(CALIBRATION_FOLDS):
        rest = part != k
        if (y[rest] > 0).any() and (y[rest] < 0).any():
            weights, bias = fit_svm(x[rest], y[rest])
            out[~rest] = x[~rest] @ weights + bias
    return out


def choose_landmarks(marking: list[str], common: list[str], room: int = LANDMARKS) -> list[str]:
    """The first of ``marking`` that are unlike the ones before, then ``common`` ones."""
    chosen: list[str] = []
    for pool, most in ((marking, room - COMMON), (common, room)):
        pool = [u for u in pool if ORDER <= len(u) <= LONGEST]
        alike = np.zeros(len(pool), dtype=bool)
        if chosen and pool:
            alike |= (Landmarks(chosen).kernel(pool) >= ALIKE).any(axis=1)
        for i, u in enumerate(pool):
            if len(chosen) >= most:
                break
            if not alike[i]:
                chosen.append(u)
                alike |= Landmarks([u]).kernel(pool)[:, 0] >= ALIKE
    return chosen


def sample_labels(labels: DataFrame, id_col: str, label: str, toxic: int = TOXIC_SAMPLE, clean: int = CLEAN_SAMPLE) -> DataFrame:
    """(id, y) of at most ``toxic + clean`` labelled rows, chosen by a hash of the id."""
    one = labels.where(quoted(id_col).isNotNull() & quoted(label).isNotNull()).groupBy(quoted(id_col).alias("s_id")).agg(F.max(quoted(label).cast("int")).alias("y"))
    pick = lambda y, n: one.where(F.col("y") == y).orderBy(F.xxhash64("s_id"), "s_id").limit(n)
    return pick(1, toxic).unionByName(pick(0, clean))


def _unit_counts(batches):
    """(unit, toxic texts, clean texts) of a task's texts."""
    counts: dict[str, list[int]] = {}
    for b in batches:
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            units = {unit_of(c) for c in chunks_of(text or "")}
            for u in {x for unit in units for x in learned_from(unit)}:
                counts.setdefault(u, [0, 0])[0 if y else 1] += 1
            if len(counts) > 500_000:
                yield _unit_batch(counts)
                counts = {}
    yield _unit_batch(counts)


def _unit_batch(counts: dict[str, list[int]]) -> pa.RecordBatch:
    pairs = list(counts.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["u", "toxic", "clean"]
    )


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Machine | None:
    """Learn from the texts of ``docs`` that ``labels`` marks; None without both kinds."""
    sample = sample_labels(labels, id_col, label)
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None
    # the sample's size is bounded above, so it can go to every task
    texts = docs.select(quoted(id_col).alias("s_id"), quoted(text).alias("text")).join(F.broadcast(sample), "s_id").select("text", F.col("y").cast("int").alias("y"))
    counted = texts.mapInArrow(_unit_counts, "u string, toxic long, clean long").groupBy("u").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    pos, neg = sizes[1] + 1.0, sizes[0] + 1.0
    odds = F.log((F.col("toxic") + 0.5) / pos) - F.log((F.col("clean") + 0.5) / neg)
    least = max(2, sizes[1] // 500)
    evidence = F.col("toxic") * F.log(F.col("toxic") / (F.col("toxic") + F.col("clean")) / (sizes[1] / (sizes[0] + sizes[1])))
    marking = counted.where((F.col("toxic") >= least) & (odds > 2) & (evidence >= EVIDENCE)).orderBy((odds * F.col("toxic")).desc(), "u").limit(CANDIDATES)
    common = counted.where(F.col("clean") >= 2).orderBy(F.col("clean").desc(), "u").limit(4 * COMMON)
    chosen = choose_landmarks([r["u"] for r in marking.select("u").collect()], [r["u"] for r in common.select("u").collect()])
    if not chosen:
        return None
    landmarks = Landmarks(chosen)
    shared = docs.sparkSession.sparkContext.broadcast(landmarks)
    width = len(chosen)

    def represent(batches):
        marks, cache = shared.value, TwoGenerations(200_000)
        for b in batches:
            texts = b.column(0).to_pylist()
            for rows in slices([len(t or "") for t in texts], SLICE_CHARS):
                values = text_values(texts[rows], marks, cache)
                flat = pa.array(values.ravel())
                yield pa.RecordBatch.from_arrays([b.column(1).slice(rows.start, len(values)), pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * width, pa.int32()), flat)], names=["y", "v"])

    table = texts.mapInArrow(represent, "y int, v array<float>").toArrow()
    if not table.num_rows:
        return None
    x = np.array(table.column("v").combine_chunks().flatten()).reshape(-1, width).astype(float)
    y = np.where(table.column("y").to_numpy() > 0, 1.0, -1.0)
    if (y > 0).all() or (y < 0).all():
        return None
    own = landmarks.kernel(chosen).astype(float)
    own = np.clip((own + own.T) / 2, 0, None) ** SHARPNESS
    val, vec = np.linalg.eigh(own)
    mapping = (vec / np.sqrt(np.maximum(val, 1e-3))) @ vec.T
    mapped = x @ mapping
    weights, bias = fit_svm(mapped, y)
    slope, offset = calibrate(margins_left_out(mapped, y), y)
    return Machine(landmarks, mapping, weights, bias, slope, offset)


def score_texts(df: DataFrame, machine: Machine | None, text: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` with the score of each text."""
    keep = without(df, [score_col]).columns
    if machine is None:
        return df.select(*[quoted(c) for c in keep], F.lit(0.0).alias(score_col))
    shared = df.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        own, cache = shared.value, TwoGenerations(250_000)
        for (array,) in batches:
            sizes = pa.compute.binary_length(array.fill_null("") if array.null_count else array).to_pylist()
            for rows in slices(sizes, SLICE_CHARS):
                values = text_values(array[rows.start : rows.stop].to_pylist(), own.landmarks, cache)
                yield rows, [pa.array(own.scores(values), pa.float64())]

    return arrow_map(df, [quoted(text)], keep, [T.StructField(score_col, T.DoubleType())], run)


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(fold_of(F.col("doc_id")) != 0)
    scored = score_texts(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
    )
