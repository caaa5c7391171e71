"""Alignment of two tokenisations of the same texts.

Each Arrow partition encodes its texts with both tokenizers and hands token intervals (number, id, byte range) to
DuckDB.  There, an equality join of the ends gives the links (tokens that end together), running window sums number
the groups of tokenizer A (stretches between common ends), an as-of join puts B's tokens into the same groups, a
range join inside the groups counts the overlaps, and links are summed by id pair.  Spark adds up the partial pair counts of all
partitions.

Neither tokenizer lets a token cross from a character that isn't white space to a single space (checked when the
files are read; else texts stay whole), so a text falls into chunks there whose alignments don't depend on each other: each
distinct chunk is aligned once, as long as the worker remembers it.

Pair counts go back to the tasks as one array.  Two tokens that end together are suffixes of one another, so there are no more
pairs than ``possible_pairs`` counts in the two vocabularies (some 324,000 for the files used here), however large the corpus.

Defined cases: null and empty texts, and texts that either tokenizer doesn't give back byte for byte, have no
tokens: zeros and empty arrays or strings; a chunk that repeats counts every time; equal rows have equal results; an empty table
gives an empty table; input columns named like an output column are replaced, all others are passed through; long texts are
handled whole (memory follows the longest text or ``SLICE_BYTES``).
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, arrow_map, quoted, read_table, slices, without
from .vocab import byte_alphabet

#: UTF-8 bytes of text whose tokens a task holds at a time.
SLICE_BYTES = 1 << 20
DUCKDB_MEMORY = "200MB"
#: Distinct chunks aligned at a time, and how many a worker keeps before it starts anew.
ALIGN_CHUNKS = 10_000
KNOWN_CHUNKS = 60_000
#: Links of texts whose counts a task looks up at a time.
SLICE_LINKS = 1 << 17
#: Fixed value: how a byte-level vocabulary cuts texts into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Below it no character was assigned after Unicode 7.
SETTLED = "\u0530"
#: A space between characters that aren't white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SQL = {
    # tokens that end together; each such end closes a group
    "cut": """CREATE OR REPLACE TEMP TABLE cut AS
        SELECT row_number() OVER (ORDER BY a.hi) - 1 AS grp, a.hi, a.n AS a_n, a.chunk, a.id * {width} + b.id AS code FROM a JOIN b ON a.hi = b.hi""",
    "a_grp": """CREATE OR REPLACE TEMP TABLE a_grp AS
        SELECT a.n, a.lo, a.hi, a.chunk, coalesce(sum((cut.a_n IS NOT NULL)::INT) OVER (ORDER BY a.n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS grp
        FROM a LEFT JOIN cut ON a.n = cut.a_n""",
    "b_grp": "CREATE OR REPLACE TEMP TABLE b_grp AS SELECT b.n, b.lo, b.hi, cut.grp FROM b ASOF JOIN cut ON b.hi <= cut.hi",
    "a": "SELECT grp FROM a_grp ORDER BY n",
    "b": "SELECT grp FROM b_grp ORDER BY n",
    "links": "SELECT chunk, code FROM cut ORDER BY grp",
    "overlaps": "SELECT a.chunk, count(*) AS n FROM a_grp a JOIN b_grp b ON a.grp = b.grp AND a.lo < b.hi AND b.lo < a.hi GROUP BY a.chunk",
    "pairs": "SELECT code, sum(w)::BIGINT AS n FROM links JOIN weights USING (chunk) GROUP BY code",
}


class Tokenizers:
    """Both vocabularies as byte strings, their encoders and a DuckDB connection; one a worker."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import duckdb
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        value = {c: b for b, c in enumerate(byte_alphabet())}
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        size = max(spec["model"]["vocab"].values()) + 1
        self.a_bytes = [b""] * size
        for entry, i in spec["model"]["vocab"].items():
            self.a_bytes[i] = bytes(value[c] for c in entry)
        # the same merges from the same file, several times as fast; its tables of letters may be of another Unicode version
        self.plain = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={x: i for i, x in enumerate(self.a_bytes) if x}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        by_words = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and spec["pre_tokenizer"]["use_regex"]
        self.cuts = by_words and not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_size, self.b_size = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        # ids as text, by what stands before them: start of a chunk, of a group, a comma, B's part
        self.names = np.array([[s + str(i) for i in range(max(len(self.a_bytes), len(pieces)))] for s in ("\n", ";", ",", "|")], dtype=object)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "preserve_insertion_order": "false"})

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; characters that were letters, digits or signs in all versions of Unicode take the short way."""
        if not self.cuts:
            return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        plain = self.plain.encode_ordinary
        out = [plain(t) if t.isascii() or max(t) < SETTLED else None for t in texts]
        odd = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(odd, self.a.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    def chunks(self, text: str) -> list[str]:
        """The text in chunks, each without the space before it."""
        return _CUT.split(text) if self.cuts else [text]


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def possible_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many pairs of entries can end together: one is a suffix of the other."""
    ours, theirs = Counter(a), Counter(b)
    longer_a = sum(theirs.get(x[k:], 0) for x in a for k in range(len(x)))
    return longer_a + sum(ours.get(x[k:], 0) for x in b for k in range(1, len(x)))


def ragged(values: np.ndarray, bounds: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The stretches ``values[bounds[i]:bounds[i+1]]`` for each i of ``order``, end to end."""
    size = np.diff(bounds)[order]
    shift = np.repeat(bounds[:-1][order] - np.cumsum(size) + size, size)
    return values[shift + np.arange(int(size.sum()))]


def _ends(counts) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


@dataclass
class Alignments:
    """Alignments of some chunks; ``x[x_at[c]:x_at[c+1]]`` belong to chunk c."""

    good: np.ndarray
    a: np.ndarray
    a_at: np.ndarray
    b: np.ndarray
    b_at: np.ndarray
    links: np.ndarray
    #: groups and links are as many: a group is closed by its link
    group_at: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    overlaps: np.ndarray
    text: list[str]

    def plus(self, more: "Alignments") -> "Alignments":
        out = {}
        for name, x in vars(self).items():
            y = vars(more)[name]
            out[name] = x + y if name == "text" else np.concatenate([x, x[-1] + y[1:] if name.endswith("_at") else y])
        return Alignments(**out)


class Known:
    """Distinct chunks a worker has aligned since it last started anew, and DuckDB's table of their links."""

    def __init__(self, own: Tokenizers):
        self.own = own
        own.db.execute("CREATE OR REPLACE TEMP TABLE links (chunk BIGINT, code BIGINT)")
        # a chunk asked for the first time gets the next place
        self.places: defaultdict[str, int] = defaultdict(count(1).__next__, {"": 0})
        self.all = align_chunks([""], own)

    def learn(self, chunks: list[str]) -> None:
        """Align chunks that have got the next places."""
        done = len(self.all.good)
        for i in range(0, len(chunks), ALIGN_CHUNKS):
            new = align_chunks(chunks[i : i + ALIGN_CHUNKS], self.own)
            number = np.repeat(np.arange(len(new.good)), np.diff(new.group_at)) + done + i
            self.own.db.register("new_links", pa.table({"chunk": number, "code": new.links}))
            self.own.db.execute("INSERT INTO links SELECT chunk, code FROM new_links")
            self.all = self.all.plus(new)

    def forget(self) -> None:
        """Free what is known: a worker lives on after its task."""
        self.own.db.execute("CREATE OR REPLACE TEMP TABLE links (chunk BIGINT, code BIGINT)")
        self.places.clear()
        del self.all

    def pairs(self, weight: np.ndarray) -> pa.Table:
        """(code, n): how many links each pair has if chunk c occurs ``weight[c]`` times."""
        some = np.flatnonzero(weight)
        self.own.db.register("weights", pa.table({"chunk": some, "w": weight[some]}))
        return self.own.db.sql(_SQL["pairs"]).to_arrow_table()


def align_chunks(chunks: list[str], own: Tokenizers) -> Alignments:
    """Align distinct chunks."""
    raw = [(" " + c).encode("utf-8") for c in chunks]
    lengths = np.array([len(x) for x in raw], np.int64)
    good = np.ones(len(chunks), bool)
    flat, counts = [], []
    for ids, entries, size in ((own.encode_a([" " + c for c in chunks]), own.a_bytes, own.a_size), (own.b.encode(chunks, num_threads=1), own.b_bytes, own.b_size)):
        n = np.array([len(x) for x in ids], np.int64)
        x = np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
        made = b"".join([entries[i] for i in x.tolist()])
        ends = _ends(size[x])[_ends(n)].tolist()
        good &= np.array([made[i:j] == y for i, j, y in zip(ends, ends[1:], raw)], bool)
        flat.append(x)
        counts.append(n)
    for side, name in enumerate("ab"):
        flat[side], counts[side] = flat[side][np.repeat(good, counts[side])], counts[side] * good
        x, size = flat[side], (own.a_size, own.b_size)[side]
        hi = np.cumsum(size[x])
        own.db.register(name, pa.table({"n": np.arange(len(x)), "id": x, "lo": hi - size[x], "hi": hi, "chunk": np.repeat(np.arange(len(chunks)), counts[side])}))
    for name in ("cut", "a_grp", "b_grp"):
        own.db.execute(_SQL[name].format(width=len(own.b_bytes)))
    fetch = lambda name: own.db.execute(_SQL[name]).fetchnumpy()
    links, overlaps = fetch("links"), fetch("overlaps")
    group_of = [np.asarray(fetch(x)["grp"], np.int64) for x in "ab"]
    group_at = _ends(np.bincount(np.asarray(links["chunk"], np.int64), minlength=len(chunks)))
    crossing = np.zeros(len(chunks), np.int64)
    crossing[np.asarray(overlaps["chunk"], np.int64)] = overlaps["n"]
    sizes = [np.bincount(g, minlength=int(group_at[-1])) for g in group_of]
    text = _as_text(flat, group_of, group_at, good, own)
    return Alignments(good, flat[0], _ends(counts[0]), flat[1], _ends(counts[1]), np.asarray(links["code"], np.int64), group_at, *sizes, crossing, text)


def _as_text(flat: list[np.ndarray], group_of: list[np.ndarray], group_at: np.ndarray, good: np.ndarray, own: Tokenizers) -> list[str]:
    """Each chunk as ``a1,a2|b1;a3|b2,b3``; a chunk that isn't good as an empty string."""
    before = []
    for g, first in zip(group_of, (1, 3), strict=True):
        new = np.append(True, g[1:] != g[:-1])[: len(g)]
        before.append(np.where(new, first, 2))
    starts = np.zeros(int(group_at[-1]) + 1, bool)
    starts[group_at[:-1][np.diff(group_at) > 0]] = True
    if len(before[0]):
        before[0][(before[0] == 1) & starts[group_of[0]]] = 0
    key = np.concatenate([2 * group_of[0], 2 * group_of[1] + 1])
    order = np.argsort(key, kind="stable")
    parts = own.names[np.concatenate(before)[order], np.concatenate(flat)[order]]
    found = iter("".join(parts.tolist()).split("\n")[1:])
    return [next(found) if g else "" for g in good.tolist()]


@dataclass
class Texts:
    """Alignments of some texts: text t is made of the chunks ``order[at[t]:at[t+1]]``, if ``good[t]``."""

    chunks: Alignments
    order: np.ndarray
    at: np.ndarray
    good: np.ndarray

    def total(self, per_chunk: np.ndarray) -> np.ndarray:
        """Sum over each good text's chunks."""
        ends = _ends(per_chunk[self.order])
        return np.where(self.good, ends[self.at[1:]] - ends[self.at[:-1]], 0)

    def lists(self, values: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """One list a text, of its chunks' stretches of ``values``."""
        order = self.order[np.repeat(self.good, np.diff(self.at))]
        return pa.LargeListArray.from_arrays(pa.array(_ends(self.total(np.diff(bounds)))), pa.array(ragged(values, bounds, order)))


def align_texts(texts: list[str | None], known: Known) -> Texts:
    places, before = known.places, len(known.places)
    order: list[int] = []
    counts = []
    for t in texts:
        parts = known.own.chunks(t) if t else []
        counts.append(len(parts))
        order += map(places.__getitem__, parts)
    known.learn(list(islice(places, before, None)))
    at, numbers = _ends(counts), np.array(order, np.int64)
    bad = _ends(~known.all.good[numbers])
    return Texts(known.all, numbers, at, (np.diff(at) > 0) & (np.diff(bad[at]) == 0))


def _aligned_slices(batches, a_path: str, b_path: str):
    """(rows, what is known, alignments) of slices of bounded size."""
    own = tokenizers(a_path, b_path)
    known = Known(own)
    for (array,) in batches:
        array = array.fill_null("") if array.null_count else array
        for rows in slices(pa.compute.binary_length(array).to_pylist(), SLICE_BYTES):
            if len(known.places) > KNOWN_CHUNKS:
                known = Known(own)
            yield rows, known, align_texts(array[rows.start : rows.stop].to_pylist(), known)
            # Arrow's allocator otherwise keeps the largest slice's buffers for as long as the worker lives
            pa.default_memory_pool().release_unused()
    known.forget()


def align(df: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``df`` with both tokenisations and their groups: ``a_ids``, ``b_ids``, and for each group how many tokens of
    A and of B it has (``group_a``, ``group_b``).  The last tokens of a group are linked."""
    names = ["a_ids", "b_ids", "group_a", "group_b"]
    keep = without(df, names).columns

    def run(batches):
        for rows, _, t in _aligned_slices(batches, a_path, b_path):
            c = t.chunks
            yield rows, [t.lists(x, at) for x, at in ((c.a, c.a_at), (c.b, c.b_at), (c.group_a, c.group_at), (c.group_b, c.group_at))]

    return arrow_map(df, [quoted(text)], keep, [T.StructField(n, T.ArrayType(T.LongType())) for n in names], run)


_SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]


def _linked(df: DataFrame, keep: list[str], a_path: str, b_path: str, text: str) -> DataFrame:
    """``keep``, counts, digest and links (as codes) of each row; pair counts of a slice stand with its first row."""
    longs, own = T.ArrayType(T.LongType()), tokenizers(a_path, b_path)
    # the second pass reads a row's links whole: half the bytes where codes allow it
    links = T.ArrayType(T.IntegerType()) if len(own.a_bytes) * len(own.b_bytes) < 1 << 31 else longs
    fields = [T.StructField(n, T.LongType()) for n in _SUMS] + [T.StructField("groups_sha256", T.StringType()), T.StructField("links", links), *[T.StructField(n, longs) for n in ("pairs", "pair_counts")]]

    def run(batches):
        for rows, known, t in _aligned_slices(batches, a_path, b_path):
            c, n = t.chunks, len(t.good)
            pairs = known.pairs(np.bincount(t.order[np.repeat(t.good, np.diff(t.at))], minlength=len(c.good)))
            order, at = t.order.tolist(), t.at.tolist()
            digests = [sha256(";".join([c.text[i] for i in order[at[k] : at[k + 1]]]).encode()).hexdigest() if good else "" for k, good in enumerate(t.good.tolist())]
            groups = t.total(np.diff(c.group_at))
            sums = [t.total(np.diff(c.a_at)), t.total(np.diff(c.b_at)), groups, groups, t.total(c.overlaps)]
            once = pa.array(np.append(0, np.full(n, len(pairs))))
            partial = [pa.LargeListArray.from_arrays(once, pairs[x].combine_chunks()) for x in ("code", "n")]
            yield rows, [*map(pa.array, sums), pa.array(digests), t.lists(c.links, c.group_at), *partial]

    return arrow_map(df, [quoted(text)], keep, fields, run)


def _ranked(batches, counts):
    """(best links, sum of counts) of each row's links, by the corpus-wide ``counts`` (codes, counts, is best)."""
    codes, totals, best = counts.value
    tokenizers.cache_clear()
    for (array,) in batches:
        offsets, links = np.asarray(array.offsets, np.int64), np.asarray(array.values)
        for rows in slices(np.diff(offsets).tolist(), SLICE_LINKS):
            at = offsets[rows.start : rows.stop + 1]
            found = np.searchsorted(codes, links[at[0] : at[-1]].astype(np.int64))
            out = []
            for values in (best, totals):
                ends = _ends(values[found])
                out.append(pa.array(ends[at[1:] - at[0]] - ends[at[:-1] - at[0]]))
            yield rows, out


def link_counts(df: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (its columns ``keep``, all by default) with counts of tokens, groups, links and overlaps, ``n_best``
    (links whose pair is its B token's most frequent one in the corpus), ``count_sum`` (corpus-wide counts of the
    links' pairs) and ``groups_sha256``."""
    spark = df.sparkSession
    own = [*_SUMS, "groups_sha256", "n_best", "count_sum"]
    rest = without(df if keep is None else df.select(*[quoted(c) for c in keep]), own).columns
    scratch = Scratch(spark, "alignment")
    named = df.select(quoted(text).alias("text"), *[quoted(c).alias(f"__tm_{i}") for i, c in enumerate(rest)])
    held = scratch.table(_linked(named, named.columns[1:], a_path, b_path, "text"))
    pairs = held.where(F.size("pairs") > 0).select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("p"))
    counted = pairs.groupBy(F.col("p.pairs").alias("code")).agg(F.sum("p.pair_counts").alias("n"))
    # bounded by the vocabularies, see possible_pairs
    table = counted.toArrow().sort_by("code")
    codes, totals = table["code"].to_numpy(), table["n"].to_numpy()
    b = codes % len(tokenizers(a_path, b_path).b_bytes)
    top = np.zeros(int(b.max()) + 1 if len(b) else 0, np.int64)
    np.maximum.at(top, b, totals)
    counts = spark.sparkContext.broadcast((codes, totals, (totals == top[b]).astype(np.int64)))
    fields = [T.StructField(n, T.LongType()) for n in ("n_best", "count_sum")]
    kept = [c for c in held.columns if c not in ("links", "pairs", "pair_counts")]
    out = arrow_map(held, [F.col("links")], kept, fields, lambda batches: _ranked(batches, counts))
    return out.toDF(*rest, *kept[len(rest) :], "n_best", "count_sum")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = link_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
