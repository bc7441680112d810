"""Small tables that only grow by a few rows a run, read whole by every run.

A log is partitioned by epoch. Rows are appended to the latest epoch, each time as a file of its own. A fold writes
everything that is to be kept into one file of a new epoch; from then on nothing else is read, so a reader opens one
file and the ones that came after the fold, however long the history is. The new epoch is there as soon as its only
file and its partition are; a fold that dies before that leaves a log as it was, one that dies later leaves a former
epoch that nobody reads. The next fold removes it. The epoch before the latest stays until then for readers that had
looked before.

A row that someone appends to an epoch while it is being folded is lost, so only one writer may be at work during a
fold; the control table sees to that.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmill.sources.tables import table_exists

EPOCH = "epoch"


def create_log(spark: SparkSession, name: str, schema: T.StructType) -> None:
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {EPOCH} bigint) USING parquet PARTITIONED BY ({EPOCH})"
    )


def epochs(spark: SparkSession, name: str) -> list[int]:
    """Epochs of the log, which are at most three."""
    if not table_exists(spark, name):
        return []
    return sorted(int(row[0].split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect())


def latest_epoch(spark: SparkSession, name: str) -> int:
    return max(epochs(spark, name), default=0)


def read_log(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """All rows that count; an empty frame before the first."""
    known = epochs(spark, name)
    if not known:
        return spark.createDataFrame([], schema)
    spark.catalog.refreshTable(name)
    return spark.table(name).filter(F.col(EPOCH) == known[-1]).select(schema.names)


def append_to_log(spark: SparkSession, name: str, schema: T.StructType, rows: DataFrame) -> None:
    known = epochs(spark, name)
    if not known:
        create_log(spark, name, schema)
    _insert(spark, name, max(known, default=0), rows.select(schema.names))


def fold_log(spark: SparkSession, name: str, schema: T.StructType, kept: DataFrame, epoch: int) -> None:
    """Go on from ``kept`` in a new epoch; see the module for who may."""
    before = epochs(spark, name)
    if not before or epoch <= before[-1]:
        raise ValueError(f"epoch {epoch} of {name} does not follow {before}")
    _insert(spark, name, epoch, kept.select(schema.names))
    for old in before[:-1]:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({EPOCH} = {old})")


def _insert(spark: SparkSession, name: str, epoch: int, rows: DataFrame) -> None:
    rows.withColumn(EPOCH, F.lit(epoch).cast("long")).coalesce(1).write.insertInto(name)
    spark.catalog.refreshTable(name)
