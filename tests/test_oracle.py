"""Every query with SQL gives the rows DuckDB computes from the same tables."""

from __future__ import annotations

import duckdb
import pytest
from tables import TABLES

import __spark_entry__ as entry
import oracle
from thermoloom.plans import catalogue

SF_DIR = "/root/testdata/sf0.01"
SQL = oracle.oracle_sql()
QUERIES = catalogue.queries()
WITHOUT_SQL = {
    "model_coefficients",
    "model_lookup",
    "forecast_score",
}
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    frame = entry.queries()[name](spark, SF_DIR)
    relation = duck.sql(SQL[name])
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {column: TYPES[kind] for column, kind in frame.dtypes} == types
    got = _rows(frame.columns, frame.collect())
    assert got
    assert got == _rows(relation.columns, relation.fetchall())


def test_queries_without_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_runs(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["source", "place", "daily", "temp_mean"]
    assert result.count() > 0
