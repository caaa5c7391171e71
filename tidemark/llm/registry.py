"""Queries of the corpus operators, and SQL where SQL expresses them; each operator's module is imported when it is asked for."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Query name: its module, and the name of its SQL there.
OPERATORS: dict[str, tuple[str, str | None]] = {
    "op1_url_filters": ("url_filters", "OP1_SQL"),
    "op2_quality_classifier": ("quality_classifier", None),
    "op3_quality_rules": ("quality_rules", "OP3_SQL"),
    "op4_token_counts": ("token_counts", None),
    "op5_decontamination": ("decontamination", "OP5_SQL"),
    "op6_near_dedup": ("near_dedup", None),
    "op7_lm_scoring": ("lm_scoring", None),
    "op8_bpe_codec": ("bpe_codec", None),
    "op9_pii": ("pii", None),
    "op10_toxicity": ("toxicity", None),
    "op11_prefix_trie": ("prefix_trie", None),
    "op12_alignment": ("alignment", None),
    "op13_simhash": ("simhash", None),
}


def load(name: str) -> tuple[Callable[[SparkSession, str], DataFrame], str | None]:
    """The query of an operator and its SQL (or None)."""
    module, sql = OPERATORS[name]
    found = importlib.import_module(f".{module}", __package__)
    return getattr(found, name), getattr(found, sql) if sql else None


def __getattr__(name: str):
    if name == "QUERIES":
        return {n: load(n)[0] for n in OPERATORS}
    if name == "ORACLE_SQL":
        return {n: load(n)[1] for n, (_, sql) in OPERATORS.items() if sql}
    raise AttributeError(name)
