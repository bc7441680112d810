"""Column lists and table schemas.

The names and their order in the tables are fixed values.
"""

from pyspark.sql import types as T

# Fields of a source record, all read as text.
RECORD_FIELDS = [
    "transaction_id",
    "account_id",
    "transaction_date",
    "amount",
    "currency",
    "transaction_type",
    "merchant_name",
    "merchant_category",
    "status",
    "country_code",
]

# The same fields as they land: the untyped amount keeps its own name.
LANDING_FIELDS = ["amount_raw" if name == "amount" else name for name in RECORD_FIELDS]
STAMP_FIELDS = ["source_system", "ingestion_timestamp"]
LANDING_COLUMNS = LANDING_FIELDS + STAMP_FIELDS

QUARANTINE_COLUMNS = LANDING_COLUMNS + ["error_reason"]

VALID_COLUMNS = [
    "transaction_id",
    "account_id",
    "transaction_date",
    "transaction_ts",
    "amount",
    "currency",
    "transaction_type",
    "merchant_name",
    "merchant_category",
    "status",
    "country_code",
] + STAMP_FIELDS

BRONZE_COLUMNS = VALID_COLUMNS + ["is_duplicate"]

# Two records that agree on all of these describe the same transaction.
NATURAL_KEY = [
    "account_id",
    "transaction_date",
    "amount",
    "currency",
    "transaction_type",
    "merchant_name",
    "merchant_category",
    "status",
    "country_code",
]

MONEY = T.DecimalType(18, 2)

COLUMN_TYPES = {
    "transaction_ts": T.TimestampType(),
    "ingestion_timestamp": T.TimestampType(),
    "amount": MONEY,
    "is_duplicate": T.BooleanType(),
    "key_hash": T.LongType(),
    "event_date": T.DateType(),
}


def schema_of(columns: list[str]) -> T.StructType:
    """Nullable schema of the named pipeline columns (text unless typed above)."""
    return T.StructType(
        [T.StructField(name, COLUMN_TYPES.get(name, T.StringType()), True) for name in columns]
    )


RECORD_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in RECORD_FIELDS])

# Rows of the control table: what happened to a batch, see plans/batches.py.
CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("number", T.LongType(), True),
        T.StructField("batch_id", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("owner", T.StringType(), True),
        T.StructField("bound", T.StringType(), True),
        T.StructField("read_rows", T.LongType(), True),
        T.StructField("left_out_rows", T.LongType(), True),
        T.StructField("new_rows", T.LongType(), True),
        T.StructField("watermark", T.StringType(), True),
        T.StructField("last_successful_watermark", T.StringType(), True),
        T.StructField("last_run_timestamp", T.StringType(), True),
        T.StructField("rows_processed", T.LongType(), True),
        T.StructField("lookback_days", T.IntegerType(), True),
    ]
)

# The saved state of incremental loads, a part of that.
WATERMARK_SCHEMA = T.StructType(
    [
        CONTROL_SCHEMA[name]
        for name in (
            "last_successful_watermark",
            "last_run_timestamp",
            "rows_processed",
            "lookback_days",
            "batch_id",
        )
    ]
)

# Entries of the ledger of source files, see sources/ledger.py.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("number", T.LongType(), True),
        T.StructField("source_file", T.StringType(), True),
        T.StructField("size", T.LongType(), True),
        T.StructField("modified", T.LongType(), True),
        T.StructField("read_from", T.StringType(), True),
        T.StructField("rows", T.LongType(), True),
        T.StructField("least", T.TimestampType(), True),
        T.StructField("greatest", T.TimestampType(), True),
    ]
)
