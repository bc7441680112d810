"""Queries that stage what they read, in a session whose staged folders cannot be removed."""

import sys
from pathlib import Path

import duckdb
import pytest
import txnmill
from checks.compare import duckdb_tables, oracle_rows, rows_of
from checks.oracles import oracle_sql
from checks.queries import QUERIES
from pyspark.sql import SparkSession

PACKAGE = str(Path(txnmill.__file__).parent)

# Two thousand events of January 2024, a few of each day.
EVENTS = """SELECT i AS event_id,
    TIMESTAMP '2024-01-01 00:00:11' + to_seconds(i * 7919 % 2591000) AS ts,
    i % 40 AS user_id,
    ['view', 'click', 'purchase', 'signup', 'error'][1 + i % 5] AS event_type,
    CAST(i * 37 % 50000 AS DOUBLE) / 100 AS value,
    '{"k": ' || i % 100 || '}' AS props
FROM range(2000) AS r(i)"""

# By finding of round 3.
STAGING = [
    "incremental_by_ledger",  # F2
    "incremental_compacted",  # F3
    "incremental_noop",  # F4
    "incremental_quarantine",  # F5
    "incremental_retry",  # F6
    "incremental_two_runs",  # F7
    "next_watermark",  # F8
    "published_bronze",  # F9
    "reconcile_counts",  # F10
    "run_metrics",  # F11
    "sink_full_load",  # F12
    "sink_summary",  # F13
    "stream_ingest",  # F14
    "summary_after_two_runs",  # F15
]


@pytest.fixture(scope="module")
def events(tmp_path_factory):
    folder = tmp_path_factory.mktemp("events")
    duckdb.sql(f"COPY ({EVENTS}) TO '{folder}/events.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture
def without_jvm(monkeypatch):
    """Code of the package cannot reach the JVM, which PySpark itself can."""
    plain = SparkSession.__getattribute__

    def guarded(session, name):
        if name in ("_jvm", "_jsc") and sys._getframe(1).f_code.co_filename.startswith(PACKAGE):
            raise PermissionError(f"no {name}")
        return plain(session, name)

    monkeypatch.setattr(SparkSession, "__getattribute__", guarded)


@pytest.mark.parametrize("name", STAGING)
def test_query_ends_well_and_is_right(spark, events, without_jvm, name):
    with pytest.warns(UserWarning, match="is left behind: no _jvm"):
        df = QUERIES[name](spark, events)
    names, expected = oracle_rows(duckdb_tables(events), oracle_sql()[name])
    assert sorted(df.columns) == names
    assert expected and rows_of(df) == expected
