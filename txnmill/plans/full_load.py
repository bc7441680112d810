"""Full load: everything the source holds replaces the tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmill.functions.times import utc_now
from txnmill.operators import landing, quality, repeats, routing, rules
from txnmill.operators.skew import HEAVY_ROWS, with_key_hash
from txnmill.plans.tables import Tables, staging
from txnmill.profiles import FULL
from txnmill.schema import BRONZE_COLUMNS, NATURAL_KEY, QUARANTINE_COLUMNS, VALID_COLUMNS
from txnmill.session import shuffle_partitions, use_utc
from txnmill.sinks.tables import write_table
from txnmill.sources.records import Source

# Rows of one bronze file (a few hundred MB of Parquet).
ROWS_PER_FILE = 2_000_000


def with_day_slots(
    rows: DataFrame, rows_per_file: int = ROWS_PER_FILE
) -> tuple[DataFrame, int]:
    """Give every row a slot within its day, as many slots as the day's rows need.

    Day and slot follow from the natural key, so shuffling by them serves the duplicate
    search and the table layout at once, and a day with a third of all rows is spread
    like the others. The broadcast side has one row per day of the profile's range (at
    most a year); returned with it is the number of slots in total.
    """
    day = F.to_date("transaction_ts")
    days = (
        rows.groupBy(day.alias("event_date"))
        .agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("slots"))
    )
    total = days.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    slotted = (
        rows.withColumn("event_date", day)
        .join(F.broadcast(days), "event_date")
        .transform(with_key_hash, NATURAL_KEY)
        .withColumn("slot", F.pmod("key_hash", "slots"))
        .drop("slots", "key_hash")
    )
    return slotted, total


def full_load(
    spark: SparkSession,
    source: Source,
    tables: Tables,
    loaded_at: str | None = None,
    table_format: str = "parquet",
    heavy_rows: int = HEAVY_ROWS,
    rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """Land, validate, route, flag duplicates; returns the run's counts (one row)."""
    use_utc(spark)
    landed = landing.stamp(landing.land(source.records, FULL), source.label, loaded_at or utc_now())
    write_table(landed, tables.landing, table_format=table_format)

    columns = list(dict.fromkeys(VALID_COLUMNS + QUARANTINE_COLUMNS + ["is_valid"]))
    validated = rules.validate(spark.table(tables.landing), FULL).select(columns)
    with staging(spark, tables, "full") as stage:
        staged = stage.write(validated, "validated")
        write_table(
            staged.filter("not is_valid").select(QUARANTINE_COLUMNS),
            tables.quarantine,
            table_format=table_format,
        )
        rows = staged.filter("is_valid").select(VALID_COLUMNS)
        slotted, slots = with_day_slots(rows, rows_per_file)
        bronze = repeats.mark_duplicates(
            slotted,
            row_count=rows.count(),
            heavy_rows=heavy_rows,
            cluster_by=["event_date", "slot"],
            partitions=max(slots, shuffle_partitions(spark)),
        )
        write_table(
            bronze.select(*BRONZE_COLUMNS, "event_date"),
            tables.bronze,
            partition_by=["event_date"],
            table_format=table_format,
        )
    return load_counts(spark, tables)


def load_counts(spark: SparkSession, tables: Tables, batch_id: str | None = None) -> DataFrame:
    """Counts from the written tables, of one batch or of all."""
    written = [spark.table(name) for name in (tables.landing, tables.quarantine, tables.bronze)]
    if batch_id is not None:
        written = [table.filter(F.col("batch_id") == batch_id) for table in written]
    return quality.run_metrics(*written)
