"""Alignments against a plain walk over both libraries' tokens."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.vocab import byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("N_A", T.StringType()), T.StructField("a.b", T.StringType())])
TEXTS = [
    None, "", " ", "  ", "a", "a ", " a", "Hello world", "Hello  world\n\tand more ", "naïve café — 東京 🙂 x", "<|endoftext|> <s> a</s> <0x41>", "a▁b c", "▁", "\x00\x01 ok",
    "it's we'll 1234567890 !!!??? ...", "word nbsp  em 　x", "x\u0085y \x1cz \x1f w", "ﬁ ½ Å é", "\U0001e900 ꟊ ꟾ Ԥ ԯ", "ab" * 300, "Hello world", "line one\nline two\r\n\r\n end",
]


def plain(texts):
    """Rows of counts, digest, best links and sums by definition, with whole texts given to the libraries."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    value = {c: i for i, c in enumerate(byte_alphabet())}
    rows, links = [], []
    for t in texts:
        pa_, pb = [], []
        if t:
            pa_ = [(i, bytes(value[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
            pb = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(t) for p in [b.id_to_piece(i)]]
            if any(b"".join(x for _, x in side) != (" " + t).encode() for side in (pa_, pb)):
                pa_, pb = [], []
        ends, spans = [], []
        for side in (pa_, pb):
            at, own, span = 0, {}, []
            for i, x in side:
                span.append((at, at + len(x)))
                at += len(x)
                own[at] = i
            ends.append(own)
            spans.append(span)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j, x, y = [], 0, 0, 0, 0
        for c in cuts:
            ga, gb = [], []
            while x < c:
                ga.append(pa_[i][0]); x += len(pa_[i][1]); i += 1
            while y < c:
                gb.append(pb[j][0]); y += len(pb[j][1]); j += 1
            groups.append((ga, gb))
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        crossing = sum(p[0] < q[1] and q[0] < p[1] for p in spans[0] for q in spans[1])
        rows.append((len(pa_), len(pb), len(groups), len(cuts), sha256(text.encode()).hexdigest() if pa_ else "", crossing, groups))
        links.append([(ends[0][c], ends[1][c]) for c in cuts])
    count = Counter(x for own in links for x in own)
    top = defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return [(*r[:4], sum(count[x] == top[x[1]] for x in own), sum(count[x] for x in own), *r[4:]) for r, own in zip(rows, links, strict=True)]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"]


def test_counts_digests_and_edges(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)]
    got = alignment.link_counts(spark.createDataFrame(rows, SCHEMA).repartition(3), A, B)
    assert got.columns[:3] == ["doc_id", "text", "a.b"] and "N_A" not in got.columns
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    assert found == {i: r[:-1] for i, r in enumerate(plain(TEXTS))}
    assert alignment.link_counts(spark.createDataFrame([], SCHEMA), A, B).count() == 0


def test_query_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted = {d.doc_id: r[:-1] for d, r in zip(docs, plain([d.text for d in docs]), strict=True)}
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.op12_alignment(spark, folder).collect()} == wanted


def test_aligned_arrays(spark):
    got = {r.doc_id: r for r in alignment.align(spark.createDataFrame([(i, t, "", "") for i, t in enumerate(TEXTS)], SCHEMA), A, B).collect()}
    for i, r in enumerate(plain(TEXTS)):
        a, b = list(got[i].a_ids), list(got[i].b_ids)
        groups = []
        for n, m in zip(got[i].group_a, got[i].group_b, strict=True):
            groups.append((a[:n], b[:m]))
            a, b = a[n:], b[m:]
        assert (groups, a, b) == (r[-1], [], [])


@pytest.mark.parametrize("kept", [50, 10**6])
def test_chunks_equal_whole_texts(monkeypatch, kept):
    """Random texts over awkward characters, with a worker that starts anew often or never."""
    monkeypatch.setattr(alignment, "KNOWN_CHUNKS", kept)
    monkeypatch.setattr(alignment, "ALIGN_CHUNKS", 40)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 2000)
    rng = random.Random(1)
    parts = ["the", "The", "a", "é", "🙂", "12", "'s", "n't", "\n", "\t", " ", "  ", " ", ".", ",", "ß", "東", "​", "\x85", "<s>", "word", "ing"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    got = []
    for _, _, t in alignment._aligned_slices([(pa.array(texts),)], A, B):
        digests = [";".join(t.chunks.text[c] for c in t.order[t.at[k] : t.at[k + 1]]) if t.good[k] else "" for k in range(len(t.good))]
        got += [sha256(x.encode()).hexdigest() if x else "" for x in digests]
    assert got == [r[6] for r in plain(texts)]


def test_pairs_are_bounded_by_suffixes():
    own = alignment.tokenizers(A, B)
    assert own.cuts and alignment.possible_pairs(own.a_bytes, own.b_bytes) < 400_000
    assert alignment.possible_pairs([b"ab", b"b"], [b"b", b"cab"]) == 4
