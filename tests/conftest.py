import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from txnmill.plans.tables import Tables  # noqa: E402
from txnmill.schema import RECORD_FIELDS, RECORD_SCHEMA  # noqa: E402
from txnmill.session import use_utc  # noqa: E402

SMALL = "/root/testdata/sf0.001"

# A record that both profiles accept.
GOOD = {
    "transaction_id": "TXN-0001",
    "account_id": "ACC-1001",
    "transaction_date": "2024-02-01T10:00:00Z",
    "amount": "10.50",
    "currency": "USD",
    "transaction_type": "debit",
    "merchant_name": "Shop",
    "merchant_category": "retail",
    "status": "completed",
    "country_code": "US",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield use_utc(session)
    session.stop()


@pytest.fixture
def records(spark):
    """Build source records from overrides of the good record."""

    def build(*overrides):
        rows = [{**GOOD, **changes} for changes in overrides]
        return spark.createDataFrame(
            [tuple(row[name] for name in RECORD_FIELDS) for row in rows], RECORD_SCHEMA
        )

    return build


@pytest.fixture
def schema(spark):
    name = f"test_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


@pytest.fixture
def tables(schema):
    return Tables.in_schema(schema)
