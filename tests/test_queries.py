"""Every registered query with SQL against DuckDB on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PLANS = {n: pair for m in entry._PLANS for n, pair in m.QUERIES.items()}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS FROM read_parquet('{p}')")
    return c


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(float(value), 6) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query_equals_sql(spark, con, name):
    query, sql = PLANS[name]
    got = query(spark, SF)
    want = con.sql(sql)
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    at = [want.columns.index(c) for c in order]
    a = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=repr)
    b = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert a == b


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_all_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
