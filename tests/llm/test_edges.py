"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, decontamination, lm_scoring, near_dedup, pii, quality_classifier, quality_rules, token_counts, toxicity, url_filters

PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 997} the and" for i in range(20_000))
ROWS = [
    (1, "The same text of some words, said twice over and again.", "http://a.com/x"),
    (1, "The same text of some words, said twice over and again.", "http://a.com/x"),
    (2, "", ""),
    (3, None, None),
    (None, "A text whose id is null, and then some more words.", "no scheme"),
    (4, LONG, "http://" + "a." * 300 + "com/" + "p/" * 500),
    (5, " \t\n ", "://"),
    (6, "x" * 5000, "http://?#"),
    (None, None, None),
    (7, "one two", "HTTP://A.COM/en/"),
]
SCHEMA = "doc_id bigint, text string, url string"
CLASHING = ["n_words", "score", "ids", "class_id", "kept", "host", "verdict", "contaminated", "items", "n_tokens", "pii_spans", "expected_grade", "k", "c", "t", "h", "band", "id", "x.y", "width", "best", "y"]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("other").alias(n) for n in CLASHING])


def _labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (4, 1, 0), (9, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")


OPERATORS = {
    "url_filters": lambda s, d: url_filters.judge_urls(d, s.createDataFrame(url_filters.RULES, "host string, path string, verdict string")),
    "quality_classifier": lambda s, d: quality_classifier.grade_texts(d, quality_classifier.fit(d, quality_classifier.graded(_labels(s)))),
    "quality_rules": lambda s, d: quality_rules.quality_rules(d),
    "token_counts": lambda s, d: token_counts.token_counts(d, PATH),
    "decontamination": lambda s, d: decontamination.decontaminate(d, s.createDataFrame([(1, "said twice over and again."), (2, None), (3, ""), (None, "one two")], "item_id bigint, text string")),
    "near_dedup": lambda s, d: near_dedup.near_duplicates(d),
    "lm_scoring": lambda s, d: lm_scoring.lm_scores(d, d.where("doc_id is not null")),
    "bpe_codec": lambda s, d: bpe_codec.decode(bpe_codec.encode(d, PATH), PATH),
    "pii": lambda s, d: pii.pseudonymize(d, b"key"),
    "toxicity": lambda s, d: toxicity.score_texts(d, toxicity.fit(d, _labels(s))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edges(spark, name):
    docs = documents(spark)
    made = OPERATORS[name](spark, docs)
    rows = made.collect()
    assert len(rows) == len(ROWS)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)
    assert all(r["x.y"] == "other" for r in rows)
    assert len(set(map(str.lower, made.columns))) == len(made.columns)
    twins = [r for r in rows if r["doc_id"] == 1]
    assert twins[0] == twins[1] or name == "lm_scoring"
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


def test_defined_values(spark):
    docs = documents(spark)
    tokens = {r["doc_id"]: r for r in token_counts.token_counts(docs.where("doc_id is not null"), PATH).collect()}
    assert tokens[2]["n_tokens"] == tokens[3]["n_tokens"] == tokens[5]["n_tokens"] == 0 and tokens[4]["over_limit"]
    kept = near_dedup.near_duplicates(docs).collect()
    assert {r["class_id"] for r in kept if r["doc_id"] == 1} == {1}
    one = near_dedup.deduplicate(docs).collect()
    assert len(one) == len(ROWS) - 1  # only the repeated row goes; texts without words stay
    rules = {r["doc_id"]: r for r in quality_rules.quality_rules(docs.where("doc_id in (2, 3)")).collect()}
    assert all(r["n_words"] == 0 and r["base_failed"] and not r["kept"] for r in rules.values())
    found = decontamination.decontaminate(docs, spark.createDataFrame([(7, "said twice over and again."), (8, "one two")], "item_id bigint, text string")).collect()
    assert {r["doc_id"]: r["items"] for r in found if r["contaminated"]} == {1: [7], 7: [8]}
    assert not any(r["contaminated"] for r in decontamination.decontaminate(docs, spark.createDataFrame([], "item_id bigint, text string")).collect())
