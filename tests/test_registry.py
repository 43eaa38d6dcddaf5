"""Every registered query against its SQL in DuckDB, and the driver contract."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import rows_of
from registry import ORACLES, QUERIES, TABLES


@pytest.fixture(scope="module")
def duck(testdata):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{testdata}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert len(QUERIES) >= 45


def test_entry(spark):
    frame = contract.entry(spark)
    assert "l_returnflag" in frame.columns and frame.count() == 6000


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, testdata, name):
    frame = QUERIES[name](spark, testdata)
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, answer.fetchall())
