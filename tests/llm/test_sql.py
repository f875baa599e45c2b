"""Queries that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from millrace.llm import oracles, queries


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    df = queries.queries()[name](spark, sf)
    columns = sorted(df.columns)
    result = con.execute(oracles.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want
