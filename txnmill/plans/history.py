"""What a batch is compared with: landed ids and hashes of stored natural keys.

Two narrow tables are written with every batch, as batch tables like the others:

* ``ids`` has every landed id once, in cleaned form, in buckets by its hash. A batch of any size is shuffled into the
  same buckets and meets the history there; the history is read where it lies.
* ``keys`` has the 64-bit hash of every natural key of bronze, sorted by day. A batch first looks for its hashes among those
  of its own days. Bronze and its wide key columns are read only if some are found, and only for these.

Hashes choose what is compared; ids and keys decide. Tables of former versions that have no such tables yet get
them from landing and bronze on the next run.
"""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmill.operators import increment
from txnmill.operators.skew import HEAVY_ROWS, with_key_hash
from txnmill.plans.tables import Staging, Tables
from txnmill.schema import NATURAL_KEY, schema_of
from txnmill.session import shuffle_partitions
from txnmill.sinks.tables import add_batch, buckets_of, create_batch_table
from txnmill.sources.tables import table_exists

ID_SCHEMA = schema_of(["transaction_id"])
KEY_SCHEMA = schema_of(["key_hash", "event_date"])

# Hashes of a batch are sent to every executor only up to this many bytes, row headers included.
BROADCAST_BYTES = 64 * 1024 * 1024
HASH_BYTES = 24


def create_history(spark: SparkSession, tables: Tables, buckets: int | None = None) -> None:
    """Create what is missing; ``buckets`` holds for the life of the table, by default as many as the
    session has shuffle partitions now."""
    n = buckets or shuffle_partitions(spark)
    first = [name for name in (tables.ids, tables.keys) if not table_exists(spark, name)]
    if first and spark.table(tables.landing).isEmpty():
        create_batch_table(spark, tables.ids, ID_SCHEMA, bucket_by="transaction_id", buckets=n)
        create_batch_table(spark, tables.keys, KEY_SCHEMA)
        return
    # A table is there when all of it is, so a run that dies here leaves the work to the next one.
    if tables.ids in first:
        landed = spark.table(tables.landing).select(increment.cleaned_id(), "batch_id").filter("transaction_id is not null")
        once = landed.groupBy("transaction_id").agg(F.min("batch_id").alias("batch_id"))
        writer = once.repartition(n, "transaction_id").write.partitionBy("batch_id")
        writer.bucketBy(n, "transaction_id").saveAsTable(tables.ids)
    if tables.keys in first:
        stored = with_key_hash(spark.table(tables.bronze), NATURAL_KEY).select("key_hash", "event_date", "batch_id")
        stored.sortWithinPartitions("batch_id", "event_date").write.partitionBy("batch_id").saveAsTable(tables.keys)


def in_buckets(spark: SparkSession, tables: Tables, ids: DataFrame) -> DataFrame:
    """Rows of one bucket in one partition each, so that a batch has one file a bucket.

    The key is put as an expression of the same hash: of the bare column Spark holds that a scan of the table has
    it already, and then reads the table without its buckets."""
    return ids.repartition(buckets_of(spark, tables.ids), F.concat("transaction_id", F.lit("")))


def add_ids(spark: SparkSession, tables: Tables, batch_id: str, fresh: DataFrame) -> None:
    """Ids of the batch, in the table's buckets, each once."""
    ids = fresh.select("transaction_id").filter("transaction_id is not null").dropDuplicates()
    add_batch(in_buckets(spark, tables, ids), tables.ids, batch_id)


def add_keys(tables: Tables, batch_id: str, rows: DataFrame) -> None:
    """Key hashes of the batch's valid rows."""
    dated = with_key_hash(rows, NATURAL_KEY).select("key_hash", F.to_date("transaction_ts").alias("event_date"))
    add_batch(by_day(dated), tables.keys, batch_id)


def by_day(keys: DataFrame) -> DataFrame:
    """Rows of a day next to each other: a reader of some days passes over the row groups of others."""
    return keys.hint("rebalance", "event_date").sortWithinPartitions("event_date")


def among(history: DataFrame, hashes: DataFrame, name: str, count: int, broadcast_bytes: int) -> DataFrame:
    """Rows of ``history`` whose hash ``name`` is among the hashes of the batch, ``count`` of them by the caller's
    account. These are broadcast if their bytes fit; the history is then cut where it is scanned. A broadcast stands
    whole in the driver and in every executor, so what is said to be few is counted before."""
    listed = hashes.select(name)
    few = broadcast_bytes // HASH_BYTES
    if count <= few and listed.count() <= few:
        return history.join(F.broadcast(listed), name, "left_semi")
    return history.join(listed, name, "left_semi")


def drop_known(
    incoming: DataFrame,
    ids: DataFrame,
    row_count: int,
    broadcast_bytes: int = BROADCAST_BYTES,
    heavy_rows: int = HEAVY_ROWS,
    cleaned: bool = False,
) -> DataFrame:
    """Incoming rows whose id has not landed. Landed ids count in the cleaned form; ``cleaned`` says that
    ``ids`` has them so, each once.

    Few rows are compared with what their hashes leave of the history. Many rows go to the history, in
    its buckets.
    """
    known = ids.select("transaction_id") if cleaned else increment.known_ids(ids)
    if row_count * HASH_BYTES <= broadcast_bytes:
        by_hash = F.xxhash64("transaction_id").alias("id_hash")
        hashes = incoming.filter("transaction_id is not null").select(by_hash)
        known = among(known.select("transaction_id", by_hash), hashes, "id_hash", row_count, broadcast_bytes)
        known = known.select("transaction_id")
    return increment.new_rows(incoming, known, row_count, heavy_rows).select(incoming.columns)


def stored_keys(
    spark: SparkSession,
    tables: Tables,
    stage: Staging,
    rows: DataFrame,
    row_count: int,
    days: Sequence[date],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame | None:
    """Stored rows that may share a natural key with ``rows``, or None if there are none.

    The date is part of the key, so only the batch's own ``days`` are looked at, however far apart they
    lie; the profile has one year of days at most.
    """
    hashes = with_key_hash(rows, NATURAL_KEY)
    sides = spark.table(tables.keys).filter(F.col("event_date").isin(days)).select("key_hash")
    found = stage.write(among(sides, hashes, "key_hash", row_count, broadcast_bytes).distinct(), "keys", ())
    count = found.count()
    if count == 0:
        return None
    same_days = spark.table(tables.bronze).filter(F.col("event_date").isin(days))
    return among(with_key_hash(same_days, NATURAL_KEY), found, "key_hash", count, broadcast_bytes).drop("key_hash")
