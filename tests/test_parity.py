"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry
from parity.oracle import ORACLE
from parity.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
TABLES = ["orders", "lineitem", "customer"]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, database, name):
    result = REGISTRY[name](spark, FOLDER)
    columns = sorted(result.columns)
    found = [tuple(row) for row in result.select(*columns).collect()]
    answer = database.execute(ORACLE[name])
    names = [part[0] for part in answer.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(column)] for column in columns) for row in answer.fetchall()]
    assert len(found) > 0
    assert in_order(found) == in_order(expected)


def test_entry(spark):
    assert entry(spark).count() > 0
