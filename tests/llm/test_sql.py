"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from conftest import SF0001
from cardflow.llm.oracle import ORACLE
from cardflow.llm.queries import QUERIES


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF0001}/documents.parquet'")
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF0001}/conversations.parquet'")
    df = QUERIES[name](spark, SF0001)
    order = sorted(df.columns)
    res = con.execute(ORACLE[name])
    names = [c[0] for c in res.description]
    assert sorted(names) == order
    want = sorted((tuple(r[names.index(c)] for c in order) for r in res.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    assert got == want
