"""Corpus pipeline over ``documents``: toxic texts go, of near-duplicates one stays, texts that contain
benchmark items go, personal data becomes pseudonyms, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
they were given.  Run stage by stage, each result is written as Parquet and read again as the next
one's input; ``run`` does the same through the shared folder.  Null or empty texts pass every
filter and are encoded to no ids; see the operators' modules for their other defined cases.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, decontamination, near_dedup, pii, toxicity
from tidemark.llm.common import materialize, quoted, read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents score at least so much to be rejected.
TOXIC_SCORE = 0.5


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; it learns from the training fold's labels."""
    labels = read_table(spark, sf_dir, "labels").where(toxicity.fold_of(F.col("doc_id")) != 0)
    scored = toxicity.score_texts(docs, toxicity.fit(docs, labels), score_col="__tm_score")
    return scored.where(F.col("__tm_score") < TOXIC_SCORE).select(*[quoted(c) for c in docs.columns])


def near_dedup_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dedup.deduplicate(docs)


def decontamination_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    marked = decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return marked.where(~F.col("contaminated")).select(*[quoted(c) for c in docs.columns])


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    return pii.pseudonymize(docs, pii.DEMO_KEY, spans_col=None)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' ids and what they decode to, with the columns ids and decoded and their digests."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe_codec.round_trip(docs, path).select("doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup_filter),
    ("decontamination", decontamination_filter),
    ("pii", pii_pseudonyms),
    ("bpe", bpe_encoding),
]

#: SQL can't express the learnt, hashed and keyed stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
