"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names and values, order-insensitive)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _key(r):
    return tuple((0, "") if x is None else (1, str(x)) for x in r)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_listed():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) == entry.WITHOUT_SQL & set(q)  # the listed ones have tests of their own


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols = df.columns
    s_rows = [tuple(_norm(x) for x in r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("rows-only query")
    rel = con.sql(sql)
    o_cols = rel.columns
    assert sorted(s_cols) == sorted(o_cols)
    idx = [o_cols.index(c) for c in s_cols]
    o_rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    assert sorted(s_rows, key=_key) == sorted(o_rows, key=_key)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["table", "p50_ms", "p95_ms", "p99_ms", "samples"]
    assert df.count() == 5
