"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import DataFrame

import __spark_entry__ as entry_points
from listenlytics.oracle import ORACLE_SQL
from listenlytics.workloads import QUERIES

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def connection(sf_dir):
    if not os.path.isdir(sf_dir):
        pytest.skip(f"no tables in {sf_dir}")
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def same_order(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


def test_names():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    result = entry_points.entry(spark)
    assert isinstance(result, DataFrame) and result.count() == 179


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, connection, name):
    result = QUERIES[name](spark, sf_dir)
    expected = connection.sql(ORACLE_SQL[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    got = same_order(tuple(row[c] for c in columns) for row in result.collect())
    positions = [expected.columns.index(c) for c in columns]
    wanted = same_order(tuple(row[p] for p in positions) for row in expected.fetchall())
    assert got == wanted
