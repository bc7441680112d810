"""Every registered query next to its SQL in DuckDB, on all rows."""

import importlib

import pytest
from checks.compare import duckdb_tables, oracle_rows, rows_of
from checks.oracles import oracle_sql
from checks.queries import QUERIES
from conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return duckdb_tables(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    df = QUERIES[name](spark, SMALL)
    names, expected = oracle_rows(connection, oracle_sql()[name])
    assert sorted(df.columns) == names
    assert rows_of(df) == expected


def test_entry_points(spark):
    module = importlib.import_module("__spark_entry__")
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(module.queries())
    assert set(module.oracle_sql()) <= set(module.queries())
    assert module.entry(spark).count() > 0
