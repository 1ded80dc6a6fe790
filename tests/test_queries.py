"""Every registered query against its check SQL, at a small scale."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload import QUERIES, SQL
from workload.registry import TABLES


def text(v):
    return None if v is None else str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, key):
    df = entry_points.queries()[key](spark, sf_dir)
    relation = duck.sql(entry_points.oracle_sql()[key])
    names = sorted(df.columns)
    assert sorted(relation.columns) == names
    places = [relation.columns.index(n) for n in names]
    expected = sorted((tuple(text(r[i]) for i in places) for r in relation.fetchall()), key=repr)
    got = sorted((tuple(text(r[n]) for n in names) for r in df.collect()), key=repr)
    assert got == expected
    assert got


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
