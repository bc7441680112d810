"""Fold the many small batches of a batch table into one.

Every batch has files of its own in each of its days, so a stream with small batches leaves many
small files. A fold copies all batches that were not folded before into one new batch, says so in the
control table, and then removes the copied ones. It is a batch like others for everyone else: who
comes meanwhile is refused. A fold that died before it was complete is cleared by the next run of
its owner; one that died after that is finished by it. Rows keep everything but their batch id.
"""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from txnmill.plans import batches
from txnmill.plans.history import by_day, in_buckets
from txnmill.plans.incremental import create_tables, new_batch_id
from txnmill.plans.tables import Tables
from txnmill.session import use_utc
from txnmill.sinks.tables import add_batch

OWNER = "compaction"


def compact(spark: SparkSession, tables: Tables, owner: str = OWNER) -> str | None:
    """Fold what came since the last fold; returns the new batch id, or None without batches."""
    use_utc(spark)
    create_tables(spark, tables)
    fold = f"{batches.FOLD}{new_batch_id()}"
    control = batches.read_control(spark, tables, fold)
    control = batches.clear_own_leftovers(spark, tables, control, fold, owner)
    if spark.table(tables.landing).filter(~F.col("batch_id").startswith(batches.FOLD)).isEmpty():
        return None
    number = batches.open_batch(spark, tables, control, fold, owner, None)
    for name, partition_by in tables.batch_tables().items():
        rows = spark.table(name).filter(~F.col("batch_id").startswith(batches.FOLD)).drop("batch_id")
        laid_out = rows.hint("rebalance", *partition_by)
        if name == tables.ids:
            laid_out = in_buckets(spark, tables, rows)
        elif name == tables.keys:
            laid_out = by_day(rows)
        add_batch(laid_out, name, fold, partition_by)
    batches.add_event(spark, tables, number + 1, fold, batches.FOLDED, owner)
    batches.finish_fold(spark, tables, number + 1, fold, owner)
    return fold
