"""Every registered query gives the same rows as its SQL counterpart."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as app
import duckdb_oracle
from compare import TABLES, compare
from tillgrain.plans import catalog

QUERIES, SQL = catalog.queries(), duckdb_oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= app.queries().keys() and SQL.keys() <= app.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    same, note = compare(spark, con, SMALL, name, QUERIES[name], SQL[name])
    assert same, note


def test_entry(spark):
    assert app.entry(spark).count() == 9951
