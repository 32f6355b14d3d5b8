"""Registered queries against their SQL on the small tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from leadline.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.6f}"
    return None if value is None else str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([str(_plain(row[i])) for i in order] for row in rows)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, tables, name):
    found = contract.queries()[name](spark, FOLDER)
    cursor = tables.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    rows = [tuple(row) for row in found.collect()]
    assert _sorted_rows(found.columns, rows) == _sorted_rows(columns, cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
