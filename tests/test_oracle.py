"""Named queries against the same results in SQL, on the smallest sample tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from barloom.catalog.oracle import ORACLE
from barloom.catalog.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
DIRECTORY = os.environ.get("BARLOOM_SAMPLE", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no sample tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIRECTORY}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value)


def ordered(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, DIRECTORY)
    answer = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    rows = df.collect()
    assert len(rows) > 0
    assert ordered(df.columns, rows) == ordered(columns, answer.fetchall())


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLE.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
