"""Registered queries against their SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check import canonical
from starloom.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, tables, name):
    con = duckdb.connect()
    for file in Path(tables).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    frame = QUERIES[name](spark, tables)
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert canonical(frame.columns, [tuple(r) for r in frame.collect()]) == canonical(names, result.fetchall())


def test_every_number_has_its_query():
    names = [n.split("_")[0] for n in queries() if n.startswith("op")]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 14))
    assert set(oracle_sql()) <= set(queries()) and "pipeline" in queries()
