"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def tidy(rows):
    norm = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted((tuple(norm(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    table = rel.df()
    want = tidy(tuple(r) for r in table[cols].astype(object).where(table[cols].notna(), None).itertuples(index=False, name=None))
    assert tidy(tuple(r) for r in df.select(*cols).collect()) == want


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["symbol", "feature", "horizon", "n", "pearson", "spearman"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
