"""Every registered query against its SQL twin on the smallest data."""

import math

import duckdb
import pytest

import __spark_entry__ as driver
from passagework.plans.inputs import TABLES

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = [tuple(row[i] for i in order) for row in rows]
    return sorted(plain, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    rows = _rows(result.columns, result.collect())
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    assert sorted(result.columns) == sorted(names)
    assert len(rows) == len(want)
    for got, expected in zip(rows, want, strict=True):
        for a, b in zip(got, expected, strict=True):
            assert a == b or (isinstance(a, float) and math.isclose(a, b, abs_tol=2e-6)), name


def test_entry(spark):
    assert driver.entry(spark).count() > 0
