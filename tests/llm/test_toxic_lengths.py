"""Insults of any length are learned and found, hidden ones too; clean texts stay clean."""

import random
import zlib

import pytest

from tidemark.llm import toxicity


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.mark.parametrize("length", [3, 5, 12, 13, 14, 16, 17, 18, 24, 30])
def test_insults_of_any_length(spark, length):
    rng = random.Random(length)
    letters = "abcdefghijklmnoprstuvwz"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    vocabulary = [word(rng.choice([2, 4, 6, 9, 13, 19])) for _ in range(400)]
    insult = word(length)
    texts, labels = [], []
    for i in range(600):
        words = rng.choices(vocabulary, k=30)
        if i % 5 == 0:
            words[rng.randrange(30)] = insult
        texts.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    docs, marks = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.fit(docs, marks.where(toxicity.fold_of(marks["doc_id"]) != 0))
    scores = {r.doc_id: r.score for r in toxicity.score_texts(docs, machine).collect()}
    held = [i for i, _ in texts if fold(i) == 0]
    found = [i for i in held if scores[i] >= 0.5]
    assert set(found) == {i for i in held if i % 5 == 0} and len(found) > 10


def test_what_is_learned_of_a_unit():
    assert toxicity.learned_from("ab") == [] and toxicity.learned_from("abc") == ["abc"]
    long = "abcdefghijklmno"
    assert toxicity.learned_from(long) == ["abcdefghijkl", "bcdefghijklm", "cdefghijklmn", "defghijklmno"]
    for n in range(13, 40):
        unit = "".join(chr(97 + i % 26) for i in range(n))
        assert all(any(x in w for w in toxicity.windows(unit)) for x in toxicity.learned_from(unit))
