"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Each pre-token's adjacent pairs are the leaves of a min tree keyed by (rank, place).  The root is
the leftmost pair of the lowest rank; merging it changes three leaves, each updated in logarithmic
time, until the root holds no mergeable pair.

Decoding maps ids to token strings joined by a space: the vocabulary files read here name no
decoder, and that is the public library's rule for them.

Defined cases: null and empty texts encode to no ids and decode to ""; ids outside the vocabulary
decode to nothing; an empty table gives an empty table; input columns named like an output column
are replaced; other columns are passed through; texts of any length are encoded whole.
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

CACHE_CHUNKS = 250_000
SLICE_CHARS = 1 << 20
_NEVER = np.int64(1) << 62
#: Up to so many pre-tokens of one size class are merged one by one.
FEW = 8


def _merge_class(sym: np.ndarray, size: np.ndarray, table: PairTable) -> None:
    """Merge rows of ``sym`` (one pre-token each, padded) in place; merged-away symbols become -1.

    ``tree[r]`` is row r's segment tree: node 1 is the root, leaf ``width + i`` holds
    (rank << 32 | i) of the pair that starts at symbol i.  Every round takes each row's root, so
    rows advance together, each by its own leftmost lowest-rank merge.
    """
    n, width = sym.shape
    tree = np.full((n, 2 * width), _NEVER)
    if width > 1:
        pair = table.rank(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(n, width - 1)
        place = np.arange(width - 1)
        fits = (pair != NO_RANK) & (place < (size - 1)[:, None])
        tree[:, width:-1][fits] = ((pair << 32) | place)[fits]
    step = width >> 1
    while step:
        tree[:, step : 2 * step] = np.minimum(tree[:, 2 * step : 4 * step : 2], tree[:, 2 * step + 1 : 4 * step : 2])
        step >>= 1
    left = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
    right = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
    flat, s, lf, rt = tree.ravel(), sym.ravel(), left.ravel(), right.ravel()
    levels = width.bit_length() - 1
    rows = np.flatnonzero(tree[:, 1] != _NEVER)
    while len(rows):
        root = flat[rows * (2 * width) + 1]
        base, trunk = rows * width, rows * (2 * width)
        i = root & 0xFFFFFFFF
        at_i = base + i
        j = rt[at_i]
        k = rt[base + j]
        s[at_i] = table.made[root >> 32]
        s[base + j] = -1
        rt[at_i] = k
        h = lf[at_i]
        has_k, has_h = k < size[rows], h >= 0
        lf[(base + k)[has_k]] = i[has_k]
        flat[trunk + width + j] = _NEVER
        ahead = np.full(len(rows), _NEVER)
        rank = table.rank(s[at_i[has_k]], s[(base + k)[has_k]])
        ahead[has_k] = np.where(rank == NO_RANK, _NEVER, (rank << 32) | i[has_k])
        flat[trunk + width + i] = ahead
        rank = table.rank(s[(base + h)[has_h]], s[at_i[has_h]])
        flat[(trunk + width + h)[has_h]] = np.where(rank == NO_RANK, _NEVER, (rank << 32) | h[has_h])
        nodes = [width + i, width + j, width + np.where(has_h, h, i)]
        for _ in range(levels):
            nodes = [x >> 1 for x in nodes]
            for x in nodes:
                flat[trunk + x] = np.minimum(flat[trunk + 2 * x], flat[trunk + 2 * x + 1])
        rows = rows[flat[trunk + 1] != _NEVER]


def _merge_one(sym: np.ndarray, table: PairTable) -> np.ndarray:
    """Symbols of one pre-token after all its merges: the same tree as `_merge_class`, walked alone.

    Numpy's cost of a round is worth it for many rows only; a long unbroken run is merged here.
    """
    n = len(sym)
    width = 1 << max(1, (n - 1).bit_length())
    never = int(_NEVER)
    leaves = np.full(width, _NEVER)
    pair = table.rank(sym[:-1], sym[1:])
    fits = np.flatnonzero(pair != NO_RANK)
    leaves[fits] = (pair[fits] << 32) | fits
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
    tree = [never, *np.concatenate(levels[::-1]).tolist()]
    symbols, left, right = sym.tolist(), list(range(-1, n - 1)), list(range(1, n + 1))
    ranks, made = table.by_pair, table.made

    def put(place: int, value: int) -> None:
        node = width + place
        tree[node] = value
        node >>= 1
        while node:
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                return
            tree[node] = low
            node >>= 1

    while (root := tree[1]) != never:
        i = root & 0xFFFFFFFF
        j = right[i]
        k, h = right[j], left[i]
        symbols[i] = own = int(made[root >> 32])
        symbols[j] = -1
        right[i] = k
        put(j, never)
        if k < n:
            left[k] = i
            rank = ranks.get((own << 32) | symbols[k])
            put(i, never if rank is None else (rank << 32) | i)
        else:
            put(i, never)
        if h >= 0:
            rank = ranks.get((symbols[h] << 32) | own)
            put(h, never if rank is None else (rank << 32) | h)
    out = np.array(symbols, dtype=np.int64)
    return out[out >= 0]


def merge_batch(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> list[np.ndarray]:
    """Merge many pre-tokens (none empty), given end to end, as far as the ranks go.

    Pre-tokens are grouped by the power of two that holds their length, and groups are cut so
    that a tree never takes much more memory than its longest pre-token needs.
    """
    starts = np.cumsum(lengths) - lengths
    out: list[np.ndarray] = [None] * len(lengths)  # type: ignore[list-item]
    power = np.ceil(np.log2(lengths)).astype(np.int64)
    for p in np.unique(power):
        width = 1 << int(p)
        members = np.flatnonzero(power == p)
        room = max(1, (1 << 18) // width)
        for cut in range(0, len(members), room):
            own = members[cut : cut + room]
            if len(own) <= FEW and width > FEW:
                for r in own:
                    out[r] = _merge_one(symbols[starts[r] : starts[r] + lengths[r]], table).astype("<u4")
                continue
            size = lengths[own]
            place = np.minimum(np.arange(width), (size - 1)[:, None])
            sym = symbols[starts[own][:, None] + place]
            sym[np.arange(width) >= size[:, None]] = -1
            _merge_class(sym, size, table)
            alive = sym >= 0
            ids = sym[alive].astype("<u4")
            ends = np.cumsum(alive.sum(axis=1))
            for row, (lo, hi) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True)):
                out[own[row]] = ids[lo:hi]
    return out


@lru_cache(maxsize=4)
def _state(path: str) -> tuple[Vocabulary, PairTable, TwoGenerations]:
    vocab = vocabulary(path)
    return vocab, PairTable(vocab), TwoGenerations(CACHE_CHUNKS)


def _learn(chunks: list[str], vocab: Vocabulary, table: PairTable, cache: TwoGenerations) -> None:
    """Encode new chunks, all pre-tokens in one batch."""
    pieces, order, sizes = vocab.distinct_pieces(chunks)
    coded = [x.tobytes() for x in merge_batch(*vocab.symbols(pieces), table)] if pieces else []
    at = 0
    for chunk, n in zip(chunks, sizes, strict=True):
        cache.young[chunk] = coded[order[at]] if n == 1 else b"".join([coded[x] for x in order[at : at + n]])
        at += n


def encode_texts(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text, packed as little-endian unsigned 32-bit integers."""
    vocab, table, cache = _state(path)
    rows = [vocab.parts(t) if t else [] for t in texts]
    fresh = cache.missing(x for row in rows for x in row if x.__class__ is str)
    for i in range(0, len(fresh), 50_000):
        _learn(fresh[i : i + 50_000], vocab, table, cache)
    known = cache.young
    out = []
    for row in rows:
        try:
            out.append(b"".join(map(known.__getitem__, row)))
        except KeyError:  # special tokens stand among the chunks
            out.append(b"".join(known[x] if x.__class__ is str else x.to_bytes(4, "little") for x in row))
    return out


def decode_ids(ids: np.ndarray | list[int], path: str) -> str:
    """Token strings of ids, joined by a space."""
    tokens = _state(path)[0].tokens
    n = len(tokens)
    return " ".join([tokens[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids) if 0 <= i < n])


def encode(df: DataFrame, tokenizer: str, text: str = "text", ids_col: str = "ids", packed_ids: bool = False, decoded_col: str | None = None) -> DataFrame:
    """``df`` with the ids of ``text``: array<int>, or packed little-endian uint32 if ``packed_ids``.

    ``decoded_col`` also decodes those ids in the same pass.
    """
    names = [ids_col] + ([decoded_col] if decoded_col else [])
    keep = without(df, names).columns
    fields = [T.StructField(ids_col, T.BinaryType() if packed_ids else T.ArrayType(T.IntegerType()))]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.StringType()))

    def run(batches):
        for (array,) in batches:
            sizes = pa.compute.binary_length(array.fill_null("") if array.null_count else array).to_pylist()
            for rows in slices(sizes, SLICE_CHARS):
                made = encode_texts(array[rows.start : rows.stop].to_pylist(), tokenizer)
                if packed_ids:
                    out = [pa.array(made, pa.binary())]
                else:
                    ends = np.cumsum([0, *(len(x) // 4 for x in made)])
                    out = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(made), "<u4").astype(np.int32)))]
                if decoded_col:
                    out.append(pa.array([decode_ids(np.frombuffer(x, "<u4"), tokenizer) for x in made], pa.string()))
                yield rows, out

    return arrow_map(df, [quoted(text)], keep, fields, run)


def decode(df: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of an array<int> column of ids; null ids decode to ""."""
    keep = without(df, [out_col]).columns

    def run(batches):
        for (array,) in batches:
            lists = array.to_pylist()
            yield slice(0, len(lists)), [pa.array([decode_ids([i for i in x or [] if i is not None], tokenizer) for x in lists], pa.string())]

    return arrow_map(df, [quoted(ids_col)], keep, [T.StructField(out_col, T.StringType())], run)


def round_trip(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` with token count and digests of the packed ids and of the decoded text."""
    made = encode(docs, tokenizer, text, ids_col="__tm_ids", packed_ids=True, decoded_col="__tm_decoded")
    return without(
        made.withColumn("n_tokens", (F.octet_length("__tm_ids") / 4).cast("long"))
        .withColumn("ids_sha256", F.sha2("__tm_ids", 256))
        .withColumn("decoded_sha256", F.sha2(F.col("__tm_decoded").cast("binary"), 256)),
        ["__tm_ids", "__tm_decoded"],
    )


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
