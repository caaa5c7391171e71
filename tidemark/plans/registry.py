"""Registered queries of the event engine and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import books, engine, files, health, oracle, queries, records, report, scans

FLAGSHIP = "feature_label_correlation"
_NO_SQL = ("block_bootstrap_ci",)
_PARTS = (books, engine, files, health, records, report, scans)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: getattr(queries, name) for name in (*oracle.SQL, *_NO_SQL)}
ORACLE_SQL: dict[str, str] = dict(oracle.SQL)
for _part in _PARTS:
    QUERIES |= _part.QUERIES
    ORACLE_SQL |= _part.SQL
