from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import near_dedup, textnum

VOCAB = [f"w{i}" for i in range(5000)]


def signatures(texts):
    for _, w in textnum.word_chunks(pa.array(texts, pa.string()), 1 << 24):
        h, b = textnum.shingles_of(w)
        return near_dedup.prob_minhash(*near_dedup.weighted_shingles(h, b), len(texts))


def j_p(a: Counter, b: Counter) -> float:
    every = set(a) | set(b)
    a, b = (defaultdict(int, {k: 1 + math.log(n) for k, n in x.items()}) for x in (a, b))
    return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in every) for x in set(a) & set(b))


def test_signature_estimates_probability_jaccard_and_similarity_is_exact():
    rng = random.Random(2)
    errors = []
    for trial in range(40):
        a = [rng.choice(VOCAB) for _ in range(rng.choice([8, 40, 300]))]
        if trial % 3 == 0:
            a = a + a[: len(a) // 2]
        b = [rng.choice(VOCAB) if rng.random() < 0.02 else w for w in a]
        grams = [Counter(tuple(t[i : i + 5]) for i in range(len(t) - 4)) for t in (a, b)]
        want = j_p(*grams)
        plain = len(set(grams[0]) & set(grams[1])) / len(set(grams[0]) | set(grams[1]))
        got = near_dedup.similarity(*[near_dedup.shingle_weights(" ".join(t)) for t in (a, b)])
        assert got == pytest.approx(max(want, plain))
        sig = signatures([" ".join(a), " ".join(b)])
        errors.append(near_dedup.estimate(sig[0], sig[1]) - want)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_signature_does_not_depend_on_neighbours():
    one = signatures(["a b c d e f g h i"])[0]
    many = signatures(["", "x y", *["q r s t u v"] * 500, "a b c d e f g h i"])[-1]
    assert (one == many).all() and not signatures(["", None]).any()


def brute(texts, threshold=0.8):
    grams = {i: frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)]) for i, t in texts for w in [re.findall(r"\S+", t.lower())]}
    index = defaultdict(list)
    for i, g in grams.items():
        for s in g:
            index[s].append(i)
    root = {i: i for i in grams}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for own in index.values():
        for a in own:
            for b in own:
                if a < b and find(a) != find(b) and len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= threshold:
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: find(i) for i in grams}


def test_classes_equal_all_pairs(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(25):
        base = [rng.choice(VOCAB) for _ in range(rng.randint(3, 150))]
        for _ in range(rng.choice([1, 1, 2, 3, 9])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                own[rng.randrange(len(own))] = rng.choice(VOCAB)
            texts.append((len(texts), " ".join(own)))
    # a chain: each link is similar to the next one only
    chain = [rng.choice(VOCAB) for _ in range(200)]
    for _ in range(8):
        texts.append((len(texts), " ".join(chain)))
        chain = chain[14:] + [rng.choice(VOCAB) for _ in range(14)]
    got = near_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    want = brute(texts)
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert sorted(r["doc_id"] for r in got if r["kept"]) == sorted(set(want.values()))
    left = near_dedup.deduplicate(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert sorted(r["doc_id"] for r in left) == sorted(set(want.values()))


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)]
    got = {r["t"]: r["root"] for r in near_dedup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and got[101] == 100


def crowd(rng, copies):
    """Copies of one text, each edited at 3 of 14 places with words of its own: all share buckets, only the last
    two, edited at the same places, are similar enough, and these share nothing that others don't."""
    base = [rng.choice(VOCAB) for _ in range(150)]
    places = rng.sample(list(combinations(range(14), 3)), copies - 1)
    out = []
    for i, edits in enumerate([*places, places[-1]]):
        own = list(base)
        for k in edits:
            own[5 + 10 * k] = f"edit{i}x{k}"
        out.append(" ".join(own))
    return out


def test_classes_of_a_crowded_bucket_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", 100)
    rng = random.Random(11)
    texts = list(enumerate(t for _ in range(3) for t in crowd(rng, 300)))
    got = near_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: i - (i % 300 == 299) for i, _ in texts}


def test_links_in_blocks_equal_all_pairs():
    rng = random.Random(12)
    base, texts = [rng.choice(VOCAB) for _ in range(150)], []
    for _ in range(70):
        own = list(base)
        for k in rng.sample(range(20), 4):
            own[5 + 7 * k] = f"edit{k}"
        texts.append(" ".join(own + own[:14] * rng.choice([0, 0, 1, 2, 3])))
    weights = [near_dedup.shingle_weights(t) for t in texts]
    left, right = np.arange(40), np.arange(30, 70)

    def parts(links):
        root = list(range(70))
        for a, b in links:
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
        return root

    want = parts([(i, j) for i in left for j in right if i != j and near_dedup.similarity(weights[i], weights[j]) >= 0.8])
    got = near_dedup.block_links(pa.array(texts), np.arange(70), left, right, 0.8)
    assert parts(got) == want and len(set(want)) not in (1, 70)


def test_copies_with_a_repeated_line_share_a_band():
    rng = random.Random(13)
    shared = 0
    for _ in range(40):
        words = [rng.choice(VOCAB) for _ in range(104)]
        own = " ".join(words)
        pair = [own, f"{own} {' '.join(words[30:44] * 20)}"]
        assert near_dedup.similarity(*[near_dedup.shingle_weights(t) for t in pair]) >= 0.8
        ((_, w),) = textnum.word_chunks(pa.array(pair))
        bands, ends = near_dedup.signature_bands(*textnum.shingles_of(w))
        shared += bool(set(bands[: ends[1]].tolist()) & set(bands[ends[1] :].tolist()))
    assert shared == 40
