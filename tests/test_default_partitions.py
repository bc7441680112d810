"""Loads in a session that leaves the number of shuffle partitions to Spark."""

import duckdb
import pytest
from checks.compare import duckdb_tables, oracle_rows, rows_of
from checks.oracles import oracle_sql
from checks.queries import QUERIES
from txnmill.session import shuffle_partitions

# Three hundred events of January 2024, some ten of each day.
EVENTS = """SELECT i AS event_id,
    TIMESTAMP '2024-01-01 00:00:11' + to_seconds(i * 7919 % 2591 * 1000) AS ts,
    i % 8 AS user_id,
    ['view', 'click', 'purchase', 'signup', 'error'][1 + i % 5] AS event_type,
    CAST(i * 37 % 50000 AS DOUBLE) / 100 AS value,
    '{"k": ' || i % 100 || '}' AS props
FROM range(300) AS r(i)"""

# By finding of round 4.
LOADS = [
    "effective_watermark",  # F9
    "incremental_by_ledger",  # F10
    "incremental_compacted",  # F11
    "incremental_noop",  # F12
    "incremental_retry",  # F13
    "incremental_quarantine",  # F14
    "incremental_two_runs",  # F15
    "next_watermark",  # F16
    "published_bronze",  # F17
    "run_metrics",  # F18
    "reconcile_counts",  # F19
    "sink_full_load",  # F20
    "sink_summary",  # F21
    "stream_ingest",  # F22
    "summary_after_two_runs",  # F23
    "watermark_state",  # F24
]


@pytest.fixture(scope="module")
def events(tmp_path_factory):
    folder = tmp_path_factory.mktemp("events")
    duckdb.sql(f"COPY ({EVENTS}) TO '{folder}/events.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture
def left_to_spark(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.unset("spark.sql.shuffle.partitions")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_count_is_sparks_own(spark, left_to_spark):
    assert shuffle_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("name", LOADS)
def test_query_ends_well_and_is_right(spark, events, left_to_spark, name):
    df = QUERIES[name](spark, events)
    names, expected = oracle_rows(duckdb_tables(events), oracle_sql()[name])
    assert sorted(df.columns) == names
    assert expected and rows_of(df) == expected
