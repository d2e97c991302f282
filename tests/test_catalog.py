"""Every registered query against its SQL in DuckDB, on the smallest data."""

from glob import glob
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from shelfcast.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert len(df.columns) == 19 and df.count() == 4215


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, result.fetchall())
