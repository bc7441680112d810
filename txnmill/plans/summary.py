"""The daily summary table: rebuilt as a whole, or kept up to date batch by batch."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmill.operators.summary import ACCOUNT_DAY, daily_summary, stamped, summary_base
from txnmill.plans import batches
from txnmill.plans.published import published
from txnmill.plans.tables import Tables, staging
from txnmill.session import use_utc
from txnmill.sinks.log import append_to_log, read_log
from txnmill.sinks.tables import replace_partitions, write_table
from txnmill.sources.tables import table_exists

# What is summarised up to which event of the control table.
REFRESH_SCHEMA = T.StructType([T.StructField("number", T.LongType(), True)])


def rebuild_summary(
    spark: SparkSession, bronze: str, summary: str, table_format: str = "parquet"
) -> None:
    """Replace the summary table from any bronze table, full or incremental. The result has
    one row per account and day, so it is written without a partitioning of its own."""
    use_utc(spark)
    write_table(
        stamped(daily_summary(summary_base(spark.table(bronze)))),
        summary,
        table_format=table_format,
    )


def refresh_summary(spark: SparkSession, tables: Tables, summary: str) -> int:
    """Bring the summary, which is partitioned by day, up to the batches that have landed; returns the days replaced.

    Batches only add rows and never change a flag of an earlier one, so account-days that the new batches do
    not touch stay as they are. The touched ones are computed again from all their rows, and the days that have
    any are replaced. Of bronze only these days are read. After that a row in ``<summary>_refreshes`` says how
    far the summary goes; a run that dies before is done again with the same result. If batches were folded before
    they were summarised, their days cannot be told apart any more, and all days of the fold are computed.
    """
    use_utc(spark)
    log = f"{summary}_refreshes"
    done = read_log(spark, log, REFRESH_SCHEMA).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    news = batches.events(spark, tables).filter((F.col("number") > done) & F.col("status").isin(batches.LANDED, batches.FOLDED))
    rows = news.select("batch_id", "number", "status").collect()  # a row per batch since the last refresh
    landed = [row for row in rows if row["status"] == batches.LANDED]
    if not landed:
        return 0
    folds = [row for row in rows if row["status"] == batches.FOLDED]
    last_fold = max((row["number"] for row in folds), default=0)
    names = [row["batch_id"] for row in landed if row["number"] > last_fold]
    if any(row["number"] < last_fold for row in landed):
        names += [row["batch_id"] for row in folds if row["number"] == last_fold]
    bronze = published(spark, tables, tables.bronze)
    days = touched_days(bronze, names)
    if days:
        with staging(spark, tables, "summary") as stage:
            new = stage.write(stamped(_touched_again(bronze, names, days)), "new", ())
            if not table_exists(spark, summary):
                empty = new.filter(F.lit(False))
                write_table(empty, summary, partition_by=["transaction_date"])
            kept = spark.table(summary).filter(F.col("transaction_date").isin(days))
            kept = kept.join(_account_days(bronze, names, days), ACCOUNT_DAY, "left_anti")
            whole = stage.write(kept.select(new.columns).unionByName(new), "whole", ())
            replace_partitions(whole.hint("rebalance", "transaction_date"), summary)
    number = max(row["number"] for row in rows)
    append_to_log(spark, log, REFRESH_SCHEMA, spark.sql("SELECT 1").select(F.lit(number).cast("long").alias("number")))
    return len(days)


def touched_days(bronze: DataFrame, names: list[str]) -> list:
    """Days that the batches have rows of, at most a year of them; read from the partitions."""
    days = bronze.filter(F.col("batch_id").isin(names)).select("event_date").distinct()
    return [row["event_date"] for row in days.collect()]


def _account_days(bronze: DataFrame, names: list[str], days: list) -> DataFrame:
    mine = bronze.filter(F.col("batch_id").isin(names) & F.col("event_date").isin(days))
    return mine.select("account_id", F.col("event_date").alias("transaction_date")).distinct()


def _touched_again(bronze: DataFrame, names: list[str], days: list) -> DataFrame:
    """The summary of the account-days that the batches touch, from all batches."""
    base = summary_base(bronze.filter(F.col("event_date").isin(days)))
    return daily_summary(base.join(_account_days(bronze, names, days), ACCOUNT_DAY, "left_semi"))
