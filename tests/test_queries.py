"""Every registered query against its SQL twin on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tidewake.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_its_sql(spark, duck, name):
    mine = registry.QUERIES[name](spark, SF)
    theirs = duck.sql(registry.SQL[name])
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert _rows(mine.columns, [tuple(r) for r in mine.collect()]) == _rows(theirs.columns, theirs.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
