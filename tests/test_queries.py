"""Every registered query against its SQL statement, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import canonical
from starloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(tables):
    connection = duckdb.connect()
    for file in Path(tables).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() <= oracle_sql().keys()
    assert QUERIES.keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, tables, name):
    frame = queries()[name](spark, tables)
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert got == canonical(names, result.fetchall())


def test_rankings_come_in_order(spark, con, tables):
    for name in ("top_suppliers", "top_band", "city_ranking"):
        got = [tuple(r) for r in queries()[name](spark, tables).collect()]
        assert got == con.execute(oracle_sql()[name]).fetchall()


def test_entry_has_rows(spark):
    assert entry(spark).count() == 5
