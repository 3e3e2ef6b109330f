"""Queries with a SQL form against it, on the smallest data set."""

import duckdb
import pytest

from omnimart.llm import queries

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    result = queries.QUERIES[name](spark, FOLDER)
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        columns = ", ".join(result.columns)
        expected = connection.execute(f"SELECT {columns} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(str, map(tuple, result.collect()))) == sorted(map(str, expected))
    assert expected
