"""Every registered query against its SQL on the smallest data set."""

import pathlib

import duckdb
import pandas as pd
import pytest

import __spark_entry__
import oracle_queries
from omnimart.plans import catalogue

FOLDER = pathlib.Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the given tables")

KINDS = {"VARCHAR": "string", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def cell(value):
    if pd.isna(value):
        return "NULL"
    return repr(float(value)) if isinstance(value, float) else str(value)


def normalised(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(cell, row)) for row in frame.itertuples(index=False))


def test_every_query_has_an_oracle():
    assert set(oracle_queries.ORACLES) == set(catalogue.QUERIES)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    result = __spark_entry__.queries()[name](spark, str(FOLDER))
    expected = duck.sql(__spark_entry__.oracle_sql()[name])
    types = {f.name: f.dataType.simpleString() for f in result.schema}
    assert types == {c: KINDS[str(t)] for c, t in zip(expected.columns, expected.types)}
    assert normalised(result.toPandas()) == normalised(expected.df())


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.count() > 0
    assert "risk_level" in result.columns
