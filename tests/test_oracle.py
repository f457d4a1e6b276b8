"""Every registered query against its DuckDB oracle at sf 0.001."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

from conftest import SF0001
import __spark_entry__ as E
from cardflow.registry import QUERIES, release
from sqlcheck.queries import ORACLE

TABLES = ["region", "nation", "customer", "orders"]


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    s_rows = [tuple(r) for r in df.collect()]
    release(spark)
    res = duck.execute(ORACLE[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _bag(df.columns, s_rows) == _bag(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "AVG_ANNUAL_INCOME" in df.columns
