"""Token counts, ids and decoded texts against the public library."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import bpe_codec, token_counts
from tidemark.llm.vocab import TwoGenerations, vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = [*"aAbBéÉΣσςİıßſ'sd  \n\t\x1c\x85\xa0١2³!<|>Ω中文éñẞ👩😀ﬁ", "<|endoftext|>", "<|startoftext|>", "'re", "the ", "aaaa", ".....", "Internationalization "]


def texts():
    rng = random.Random(11)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + ["", "a" * 3000, "x" * 999 + "!" * 500, "abcabc" * 400]


def test_counts_and_ids_equal_the_library():
    own = texts()
    lib = Tokenizer.from_file(PATH)
    want = [e.ids for e in lib.encode_batch(own, add_special_tokens=False)]
    assert token_counts.count_texts(own, PATH) == [len(x) for x in want]
    got = [np.frombuffer(x, "<u4").tolist() for x in bpe_codec.encode_texts(own, PATH)]
    assert got == want
    assert [bpe_codec.decode_ids(x, PATH) for x in got] == [lib.decode(x, skip_special_tokens=False) for x in want]


def test_segment_tree_equals_one_merge_at_a_time():
    vocab = vocabulary(PATH)
    table = bpe_codec.PairTable(vocab)
    rng = random.Random(5)
    pieces = ["".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 40))).encode() for _ in range(400)]
    merged = bpe_codec.merge_batch(*vocab.symbols(pieces), table)
    counts = token_counts.merged_lengths(*vocab.symbols(pieces), table)
    for piece, ids, count in zip(pieces, merged, counts, strict=True):
        sym = vocab.symbols([piece])[0].tolist()
        while True:
            ranked = [(vocab.merges[p][0], i) for i, p in enumerate(zip(sym, sym[1:])) if p in vocab.merges]
            if not ranked:
                break
            i = min(ranked)[1]
            sym[i : i + 2] = [vocab.merges[sym[i], sym[i + 1]][1]]
        assert ids.tolist() == sym and count == len(sym)


def test_cache_is_bounded():
    cache = TwoGenerations(10)
    for i in range(1000):
        for k in cache.missing([i, i // 2]):
            cache.young[k] = k
    assert len(cache.young) + len(cache.old) <= 24


def test_encode_decode_columns(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts()[:200])], "id int, text string")
    lib = Tokenizer.from_file(PATH)
    for r in bpe_codec.decode(bpe_codec.encode(df, PATH), PATH).collect():
        ids = lib.encode(r["text"], add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == lib.decode(ids, skip_special_tokens=False)


def test_long_unbroken_runs_equal_the_library():
    rng = random.Random(5)
    lib = Tokenizer.from_file(PATH)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "ab", "a", "aé0"):
        for n in (30, 400, 5000):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert np.frombuffer(bpe_codec.encode_texts([text], PATH)[0], "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
