"""Every registered query runs, and equals its SQL where it has one."""

from __future__ import annotations

import math

import duckdb
import pytest

from millrace import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return None if math.isnan(float(v)) else round(float(v), 4)
    return str(v)


def in_order(rows):
    return sorted(rows, key=lambda r: [(x is None, type(x).__name__, str(x) if isinstance(x, (bool, type(None))) else x) for x in r])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = in_order([tuple(plain(r[c]) for c in columns) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = in_order([tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()])
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == y or isinstance(x, float) and isinstance(y, float) and x == pytest.approx(y, abs=2e-4)


def test_group_split_query(spark, sf):
    out = QUERIES["group_split"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert out.count() == docs.count()
    shares = {r["split"]: r["count"] / docs.count() for r in out.groupBy("split").count().collect()}
    assert shares.keys() == {"train", "validation", "test"} and abs(shares["test"] - 0.2) < 0.08


def test_sample_query(spark, sf):
    q = QUERIES["seeded_sample"]
    assert q(spark, sf).collect() == q(spark, sf).collect() and q(spark, sf).count() == 100


def test_models_beat_the_median(spark, sf):
    board = {r["experiment"]: r for r in QUERIES["ridge_ladder"](spark, sf).collect()}
    assert len(board) == 5 and all(r["status"] == "ok" for r in board.values())
    assert board["E1"]["log_rmse"] < 0.7 * board["E0"]["log_rmse"] and board["E2"]["log_r2"] > 0.5
    for name in ("forest", "boosting"):
        assert QUERIES[name](spark, sf).first()["log_r2"] > 0.5
    tried = QUERIES["tuning"](spark, sf).collect()
    assert sorted(r["rank"] for r in tried) == [1, 2, 3]


def test_batch_score_query(spark, sf):
    rows = QUERIES["batch_score"](spark, sf).collect()
    assert any(r["reject_reason"] == "title" and r["prediction"] is None for r in rows)
    assert all(r["prediction"] > 0 for r in rows if r["reject_reason"] is None)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
