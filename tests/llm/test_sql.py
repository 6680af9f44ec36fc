"""Queries that SQL can express, on the given tables against DuckDB."""

from pathlib import Path

import duckdb
import pytest

from duoscope.llm import queries
from tests.test_queries import SF, plain


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS FROM read_parquet('{p}')")
    got, want = queries.queries()[name](spark, SF), con.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    at = [want.columns.index(c) for c in order]
    a = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=repr)
    assert a == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
