"""The pipeline stage by stage against plain Python on the smallest table."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_near_dedup import brute
from tidemark.llm import pii, toxicity

SF = "/root/testdata/sf0.001"


def shingled(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.columns == docs.columns
            out = corpus_pipeline.materialize(out, f"test-{name}")
        steps[name] = (docs.collect(), out.collect())
        docs = out
    assert list(steps) == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"]

    before, after = steps["toxicity"]
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_texts(spark.createDataFrame(before), toxicity.fit(spark.createDataFrame(before), spark.read.parquet(f"{SF}/labels.parquet").where("crc32(cast(doc_id as string)) % 5 != 0"))).collect()}
    assert {r["doc_id"] for r in after} == {i for i, s in scores.items() if s < 0.5} and len(after) < len(before)

    before, after = steps["near_dedup"]
    classes = brute([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(set(classes.values()))

    before, after = steps["decontamination"]
    items = [shingled(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {r["doc_id"]: shingled(r["text"]) for r in before}
    dirty = {i for i, g in grams.items() if any(s and len(s & g) / len(s) >= 0.8 for s in items)}
    assert {r["doc_id"] for r in after} == set(grams) - dirty

    before, after = steps["pii"]
    assert {r["doc_id"]: r["text"] for r in after} == {r["doc_id"]: pii.rewrite(r["text"], pii.DEMO_KEY)[0] for r in before}

    before, after = steps["bpe"]
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        ids = lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_take_empty_tables_and_nulls(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for rows in ([], [(None, None, None, None, None), (1, "", None, None, 0), (2, "one two three", "en", "s", 13)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert docs.count() == len(rows)
