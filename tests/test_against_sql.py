"""Every registered query against its SQL, run by another engine on the same tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from tilewright.plans import all_queries  # noqa: E402

QUERIES = all_queries()
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for file in os.listdir(sf):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{sf}/{file}'")
    return connection


def plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and math.isnan(value):
        return None
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(tuple(plain(row[i]) for i in places) for row in cursor.fetchall())
    assert got == want


def test_flagship_has_rows(spark):
    assert contract.entry(spark).count() > 0
