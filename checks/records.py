"""Dirty transaction records derived from the ``events`` table.

Faults are planted by the event id, so Spark and DuckDB build the same rows; every
50th event comes a second time under another id. The expressions are common SQL; the two
dialects differ in reading the JSON field and in writing the timestamp.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmill.session import use_utc

MONEY_TEXT = "CAST(CAST(value AS DECIMAL(18,2)) AS STRING)"

FIELDS = {
    "transaction_id": """CASE WHEN event_id % 127 = 0 THEN ''
        WHEN event_id % 113 = 0 THEN CONCAT('txn-', CAST(event_id AS STRING))
        ELSE CONCAT('TXN-', CAST(event_id AS STRING)) END""",
    "account_id": """CASE WHEN event_id % 211 = 0 THEN 'ACC-1021'
        WHEN event_id % 223 = 0 THEN 'ACC-12'
        ELSE CONCAT('ACC-', CAST(1001 + user_id % 20 AS STRING)) END""",
    "transaction_date": """CASE WHEN event_id % 97 = 0 THEN '2024-11-31T14:22:00Z'
        WHEN event_id % 101 = 0 THEN '2024-04-15 09:30:00'
        WHEN event_id % 131 = 0 THEN '2024-05-01T00:00:00Z'
        WHEN event_id % 137 = 0 THEN '2023-12-31T23:59:59Z'
        WHEN event_id % 239 = 0 THEN NULL ELSE {ts} END""",
    "amount_raw": f"""CASE WHEN event_id % 89 = 0 THEN CONCAT('-', {MONEY_TEXT})
        WHEN event_id % 83 = 0 THEN CONCAT({MONEY_TEXT}, '5')
        WHEN event_id % 79 = 0 THEN 'abc'
        WHEN event_id % 73 = 0 THEN NULL ELSE {MONEY_TEXT} END""",
    "currency": """CASE WHEN event_id % 71 = 0 THEN 'usd' WHEN event_id % 67 = 0 THEN ' USD'
        WHEN event_id % 7 = 0 THEN 'USD' WHEN event_id % 7 = 1 THEN 'EUR'
        WHEN event_id % 7 = 2 THEN 'GBP' WHEN event_id % 7 = 3 THEN 'CHF'
        WHEN event_id % 7 = 4 THEN 'JPY' WHEN event_id % 7 = 5 THEN 'AUD' ELSE 'CAD' END""",
    "transaction_type": """CASE WHEN event_id % 61 = 0 THEN 'Credit'
        WHEN event_type IN ('purchase', 'click', 'view') THEN 'debit' ELSE 'credit' END""",
    "merchant_name": "CASE WHEN event_id % 103 = 0 THEN '   ' ELSE CONCAT('M', {k}) END",
    "merchant_category": """CASE WHEN event_id % 59 = 0 THEN 'Finance'
        WHEN event_id % 12 = 0 THEN 'e-commerce' WHEN event_id % 12 = 1 THEN 'travel'
        WHEN event_id % 12 = 2 THEN 'food_and_beverage' WHEN event_id % 12 = 3 THEN 'groceries'
        WHEN event_id % 12 = 4 THEN 'electronics' WHEN event_id % 12 = 5 THEN 'retail'
        WHEN event_id % 12 = 6 THEN 'entertainment' WHEN event_id % 12 = 7 THEN 'health'
        WHEN event_id % 12 = 8 THEN 'transportation' WHEN event_id % 12 = 9 THEN 'home_and_garden'
        WHEN event_id % 12 = 10 THEN 'payroll' ELSE 'transfer' END""",
    "status": """CASE WHEN event_id % 107 = 0 THEN 'Completed' WHEN event_id % 10 = 7 THEN 'pending'
        WHEN event_id % 10 = 8 THEN 'failed' WHEN event_id % 10 = 9 THEN 'reversed'
        ELSE 'completed' END""",
    "country_code": """CASE WHEN event_id % 109 = 0 THEN 'UK' WHEN event_id % 149 = 0 THEN 'usa'
        WHEN event_id % 2 = 0 THEN 'US' ELSE 'DE' END""",
}

SPARK_DIALECT = {
    "k": "get_json_object(props, '$.k')",
    "ts": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
}
DUCKDB_DIALECT = {
    "k": "json_extract_string(props, '$.k')",
    "ts": "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')",
}


def landed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records under their landing names, from one scan of ``events``."""
    events = use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")
    fields = [F.expr(text.format(**SPARK_DIALECT)).alias(name) for name, text in FIELDS.items()]
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(""), F.lit("D"))).otherwise(
        F.array(F.lit(""))
    )
    # Fields first, copies second: later predicates then read the fields instead of
    # computing them again.
    built = events.select(*fields, copies.alias("copies"))
    return built.select(*FIELDS, F.explode("copies").alias("suffix")).select(
        F.concat("transaction_id", "suffix").alias("transaction_id"), *list(FIELDS)[1:]
    )


def source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records under their source names."""
    return landed_fields(spark, sf_dir).withColumnRenamed("amount_raw", "amount")


def duckdb_records() -> str:
    """The same rows in DuckDB, under their landing names."""
    fields = ",\n    ".join(f"{text.format(**DUCKDB_DIALECT)} AS {name}" for name, text in FIELDS.items())
    names = ", ".join(FIELDS)
    copies = names.replace("transaction_id", "CONCAT(transaction_id, 'D') AS transaction_id", 1)
    return f"""SELECT {names} FROM (SELECT {fields} FROM events) AS f
    UNION ALL
    SELECT {copies} FROM (SELECT {fields}, event_id FROM events) AS g WHERE event_id % 50 = 0"""
