"""Every query with SQL beside it gives DuckDB's rows on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from rowkin.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        path = f"{SF}/{name}"
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def cell(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "NULL"
    return f"{x:.6g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_rows_equal_the_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    place = [want.columns.index(c) for c in columns]
    mine = sorted(tuple(cell(x[c]) for c in columns) for x in got.collect())
    assert mine == sorted(tuple(cell(row[i]) for i in place) for row in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
