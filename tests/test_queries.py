"""Every registered query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "/root/testdata/sf0.001"
NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="the given tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "missing"
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, str):
        return value
    return repr(float(value))


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(_plain, row)) for row in frame.itertuples(index=False, name=None))


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, database, name):
    found = entry.QUERIES[name](spark, TABLES).toPandas()
    expected = database.execute(entry.ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert _rows(found) == _rows(expected)
