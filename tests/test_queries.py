"""Every registered query against its SQL statement, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    frame = entry.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    result = tables.execute(entry.oracle_sql()[name])
    given = [d[0] for d in result.description]
    assert sorted(given) == columns
    order = [given.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in result.fetchall()]
    actual = [tuple(row[c] for c in columns) for row in frame.collect()]
    assert expected
    assert _sorted(actual) == _sorted(expected)


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
