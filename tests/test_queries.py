"""Every registered query against its oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import query_suite


@pytest.fixture(scope="module")
def oracle(sf):
    connection = duckdb.connect()
    for file in os.listdir(sf):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{file}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_an_oracle():
    assert set(query_suite.QUERIES) == set(query_suite.ORACLES)
    assert set(query_suite.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(query_suite.QUERIES))
def test_query(spark, sf, oracle, name):
    df = entry.queries()[name](spark, sf)
    cursor = oracle.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = cursor.fetchall()
    found = [tuple(r) for r in df.select(*columns).collect()]
    assert ordered(found) == ordered(expected)
    assert expected


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
