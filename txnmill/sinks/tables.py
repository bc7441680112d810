"""Table writers: whole-table overwrite, append, and rows of one batch.

A batch table is partitioned by ``batch_id`` first. A batch is appended to once. What a dead run
left of it is cleared before by a static partition overwrite, which removes everything under
``batch_id=...``. Batch tables are Parquet (or another file format of the catalog).
"""

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
) -> None:
    writer = df.write.format(table_format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def append_if_not_empty(df: DataFrame, name: str, table_format: str = "parquet") -> bool:
    """Append, creating the table if need be; without rows nothing is touched. Emptiness
    is a limit-1 probe, so pass a table or a staged frame rather than a long plan."""
    if df.isEmpty():
        return False
    df.write.format(table_format).mode("append").saveAsTable(name)
    return True


def create_batch_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
    bucket_by: str | None = None,
    buckets: int = 0,
) -> None:
    """Empty table with ``batch_id`` and then ``partition_by`` as partition columns, and rows of a
    partition in files by the hash of ``bucket_by`` if that is named."""
    columns = [f"{field.name} {field.dataType.simpleString()}" for field in schema]
    if "batch_id" not in schema.names:
        columns.append("batch_id string")
    bucketed = f" CLUSTERED BY ({bucket_by}) INTO {buckets} BUCKETS" if bucket_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING {table_format} "
        f"PARTITIONED BY ({', '.join(['batch_id', *partition_by])}){bucketed}"
    )


def buckets_of(spark: SparkSession, name: str) -> int:
    """Number of buckets of a bucketed table."""
    described = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Num Buckets'").first()
    return int(described["data_type"])


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def _checked(batch_id: str) -> str:
    if not re.fullmatch(r"[\w.-]+", batch_id):
        raise ValueError(f"batch ids consist of letters, digits, '.', '_' and '-', not {batch_id!r}")
    return batch_id


def _put(df: DataFrame, name: str, batch_id: str, partition_by: Sequence[str], verb: str) -> None:
    spark = df.sparkSession
    stored = [field for field in spark.table(name).columns if field != "batch_id"]
    spec = ", ".join([f"batch_id = '{_checked(batch_id)}'", *partition_by])
    spark.sql(f"INSERT {verb} TABLE {name} PARTITION ({spec}) SELECT * FROM {{df}}", df=df.select(stored))


def clear_batch(
    spark: SparkSession, name: str, batch_id: str, partition_by: Sequence[str] = ()
) -> None:
    """Remove whatever the table holds of this batch, by overwriting it with nothing."""
    nothing = spark.createDataFrame([], spark.table(name).schema)
    with _overwrite_mode(spark, "STATIC"):
        _put(nothing, name, batch_id, partition_by, "OVERWRITE")


def replace_partitions(df: DataFrame, name: str) -> None:
    """Put the rows in place of what the partitions that they belong to hold; other partitions stay. ``df`` must not
    read the table."""
    with _overwrite_mode(df.sparkSession, "DYNAMIC"):
        df.select(df.sparkSession.table(name).columns).write.mode("overwrite").insertInto(name)


def add_batch(df: DataFrame, name: str, batch_id: str, partition_by: Sequence[str] = ()) -> None:
    """Append ``df``, which may read other batches of the table, as rows of the batch."""
    _put(df, name, batch_id, partition_by, "INTO")


def drop_batches(spark: SparkSession, name: str, unwanted: Callable[[str], bool]) -> None:
    """Drop the partitions of whole batches, a hundred at a time, from the table's partition list."""
    spark.catalog.refreshTable(name)
    parts = (row["partition"] for row in spark.sql(f"SHOW PARTITIONS {name}").toLocalIterator())
    specs = (dict(level.split("=", 1) for level in part.split("/")) for part in parts)
    clauses = [
        "PARTITION (" + ", ".join(f"{key} = '{value}'" for key, value in spec.items()) + ")"
        for spec in specs
        if unwanted(_checked(spec["batch_id"]))
    ]
    for i in range(0, len(clauses), 100):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(clauses[i : i + 100])}")
    spark.catalog.refreshTable(name)


def export_csv(df: DataFrame, path: str) -> None:
    """One folder of CSV parts. Blanks at the ends of a value are data and stay."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
