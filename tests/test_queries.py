"""Each query against its SQL in DuckDB, on the smallest data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
import query_catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = query_catalog.QUERIES, query_catalog.ORACLES


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.4f}"
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(comparable(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    ours = table_of(df.columns, df.collect())
    oracle = duck.execute(ORACLES[name])
    theirs = table_of([column[0] for column in oracle.description], oracle.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())
