"""Every registered query against its DuckDB oracle on the smallest data set (rows-only for the
queries without an oracle)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from erascore.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 100


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    df = QUERIES[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert len(got) > 0
        return
    rel = con.execute(ORACLE[key])
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, rel.fetchall())


def test_entry(spark):
    out = entry.entry(spark).collect()
    assert len(out) == 1 and set(out[0].asDict()) == {"corr_mean", "corr_std", "sharpe", "payout"}
