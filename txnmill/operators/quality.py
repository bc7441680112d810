"""Checks on the built tables; each returns the rows that break it."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.operators.summary import ACCOUNT_DAY, SUMMARY_COLUMNS


def null_fields(summary: DataFrame, columns: list[str] = SUMMARY_COLUMNS) -> DataFrame:
    return summary.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def repeated_days(summary: DataFrame) -> DataFrame:
    return summary.groupBy(ACCOUNT_DAY).agg(F.count("*").alias("n")).filter("n > 1")


def wrong_net(summary: DataFrame) -> DataFrame:
    expected = F.col("total_credit_amount") - F.col("total_debit_amount")
    return summary.filter(F.col("net_amount") != expected)


def empty_days(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("transaction_count") <= 0)


def run_metrics(landing: DataFrame, quarantine: DataFrame, bronze: DataFrame) -> DataFrame:
    """Row counts of a load, one row. Counting the written tables reads file footers
    and the flag column only, and stays exact when tasks were retried."""
    counts = bronze.agg(
        F.count("*").alias("bronze_rows"),
        F.count_if(~F.col("is_duplicate")).alias("unique_rows"),
        F.count_if("is_duplicate").alias("duplicate_rows"),
    )
    landed = landing.agg(F.count("*")).scalar()
    rejected = quarantine.agg(F.count("*")).scalar()
    return counts.select(
        landed.alias("landing_rows"),
        rejected.alias("quarantine_rows"),
        "bronze_rows",
        "unique_rows",
        "duplicate_rows",
    )


def reconcile(metrics: DataFrame) -> DataFrame:
    """Every landed row is either in quarantine or in bronze."""
    stored = F.col("quarantine_rows") + F.col("bronze_rows")
    return metrics.select(
        "landing_rows",
        "quarantine_rows",
        "bronze_rows",
        (F.col("landing_rows") == stored).alias("reconciled"),
    )
