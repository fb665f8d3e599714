"""Every registered query against its expected result in DuckDB."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as registered

QUERIES, ORACLES = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in os.listdir(TESTDATA):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{TESTDATA}/{file}'")
    yield connection
    connection.close()


def shown(value) -> str:
    return repr(float(value)) if isinstance(value, float) else str(value)


def bag(columns, names, rows) -> Counter:
    places = [names.index(c) for c in columns]
    return Counter(tuple(shown(row[i]) for i in places) for row in rows)


def test_each_query_of_the_job_has_an_expected_result():
    assert set(registered.QUERIES) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, tables, name):
    got = QUERIES[name](spark, TESTDATA)
    want = tables.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    columns = sorted(got.columns)
    assert columns == sorted(names)
    expected = bag(columns, names, want.fetchall())
    actual = bag(columns, got.columns, got.collect())
    assert sum(expected.values()) > 0
    assert actual == expected


def test_flagship(spark):
    result = registered.entry(spark)
    assert result.count() > 0 and "marketplace" in result.columns
