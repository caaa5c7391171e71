"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch are held as one ragged pair of numpy arrays (symbols, sequence numbers).
A round finds every sequence's lowest merge rank and applies that pair at all its places at once;
sequences without a mergeable pair leave the array with the number of symbols they have left.
Merges of a trained vocabulary are ranked in the order they were learnt, so no pair made by a merge
has a lower rank than the merge itself, and a round equals the one-by-one merges it stands for.

Defined cases: null and empty texts have 0 bytes and 0 tokens; equal texts have equal counts; an
empty table gives an empty table; input columns named like an output column are replaced; every
other column is passed through; texts of any length are counted whole (the memory of a batch is
bounded by the longest single text).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, quoted, read_table, slices, without
from .vocab import NO_RANK, PairTable, TwoGenerations, Vocabulary, vocabulary

#: Chunk results a Python worker keeps (per generation).
CACHE_CHUNKS = 250_000
#: Characters of text handled at a time.
SLICE_CHARS = 1 << 21


def merged_lengths(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> np.ndarray:
    """How many symbols each sequence keeps.  ``symbols``: all sequences (none empty) end to end."""
    out = lengths.astype(np.int64)
    seq = np.repeat(np.arange(len(lengths)), lengths)
    sym = symbols.astype(np.int64)
    while len(sym):
        rank = np.full(len(sym), NO_RANK)
        same = seq[:-1] == seq[1:]
        if same.any():
            at = np.flatnonzero(same)
            rank[at] = table.rank(sym[at], sym[at + 1])
        heads = np.flatnonzero(np.append(True, ~same))
        low = np.minimum.reduceat(rank, heads)
        size = np.diff(np.append(heads, len(sym)))
        ended = low == NO_RANK
        if ended.any():
            out[seq[heads[ended]]] = size[ended]
            stay = np.repeat(~ended, size)
            sym, seq, rank = sym[stay], seq[stay], rank[stay]
            low, size = low[~ended], size[~ended]
            if not len(sym):
                break
        hit = np.flatnonzero(rank == np.repeat(low, size))
        # of pairs that overlap (as in "aaa") every second one, from the left, merges
        run = np.append(True, np.diff(hit) > 1)
        first = np.flatnonzero(run)
        place = np.arange(len(hit)) - np.repeat(first, np.diff(np.append(first, len(hit))))
        hit = hit[place % 2 == 0]
        sym[hit] = table.made[rank[hit]]
        left = np.ones(len(sym), dtype=bool)
        left[hit + 1] = False
        sym, seq = sym[left], seq[left]
    return out


@lru_cache(maxsize=4)
def _state(path: str) -> tuple[Vocabulary, PairTable, TwoGenerations]:
    vocab = vocabulary(path)
    return vocab, PairTable(vocab), TwoGenerations(CACHE_CHUNKS)


def _learn(chunks: list[str], vocab: Vocabulary, table: PairTable, cache: TwoGenerations) -> None:
    """Count the tokens of new chunks, all in one ragged array."""
    pieces, order, sizes = vocab.distinct_pieces(chunks)
    counts = np.zeros(len(chunks), dtype=np.int64)
    if order:
        left = merged_lengths(*vocab.symbols(pieces), table)[order]
        owners = np.repeat(np.arange(len(chunks)), sizes)
        counts = np.bincount(owners, weights=left, minlength=len(chunks)).astype(np.int64)
    cache.young.update(zip(chunks, counts.tolist(), strict=True))


def count_texts(texts: list[str | None], path: str) -> list[int]:
    """Tokens of each text."""
    vocab, table, cache = _state(path)
    rows = [vocab.parts(t) if t else [] for t in texts]
    words = [x for row in rows for x in row if x.__class__ is str]
    fresh = cache.missing(words)
    for i in range(0, len(fresh), 50_000):
        _learn(fresh[i : i + 50_000], vocab, table, cache)
    known = cache.young
    out = []
    for row in rows:
        try:
            out.append(sum(map(known.__getitem__, row)))
        except KeyError:  # special tokens stand among the chunks
            out.append(sum(known[x] if x.__class__ is str else 1 for x in row))
    return out


def token_counts(
    df: DataFrame, tokenizer: str, text: str = "text", limit: int = 2048, bytes_col: str = "n_bytes", tokens_col: str = "n_tokens", over_col: str = "over_limit"
) -> DataFrame:
    """``df`` with the UTF-8 bytes and tokens of ``text`` and whether they exceed ``limit`` tokens."""
    keep = without(df, [bytes_col, tokens_col, over_col]).columns

    def run(batches):
        for (array,) in batches:
            lengths = array.fill_null("") if array.null_count else array
            sizes = pa.compute.binary_length(lengths).to_pylist()
            for rows in slices(sizes, SLICE_CHARS):
                part = array[rows.start : rows.stop].to_pylist()
                yield rows, [pa.array(sizes[rows], pa.int64()), pa.array(count_texts(part, tokenizer), pa.int64())]

    fields = [T.StructField(bytes_col, T.LongType()), T.StructField(tokens_col, T.LongType())]
    return arrow_map(df, [quoted(text)], keep, fields, run).withColumn(over_col, quoted(tokens_col) > F.lit(limit))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")
