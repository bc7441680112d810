"""Continuous ingest: new files go through the incremental batch as they arrive.

The checkpoint of the stream takes the place of the saved watermark. The file source
tracks files, not event times, so late records are never left out; repeats are found in
the tables, not in a state with a time limit. A micro-batch that is delivered twice is
stored once, because its batch id is made of the stream's name and its number. A stream and
loads may write the same tables, one at a time: who comes while a batch is open is refused.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txnmill.plans.incremental import run_batch
from txnmill.plans.tables import Tables
from txnmill.schema import RECORD_FIELDS, RECORD_SCHEMA
from txnmill.session import use_utc
from txnmill.sources.records import CSV_LABEL, CSV_OPTIONS, Source, by_name


def read_csv_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None, multi_line: bool = True
) -> DataFrame:
    """Fields are found by name in the header of the files that are there at the start; without
    files the usual order is expected. A file with another header fails the query."""
    try:
        names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    except AnalysisException:
        names = RECORD_FIELDS
    schema = T.StructType([T.StructField(name, T.StringType(), True) for name in names])
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS).option("multiLine", multi_line)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return by_name(reader.csv(path))


def read_json_lines_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(RECORD_SCHEMA).option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def start_ingest(
    records: DataFrame,
    tables: Tables,
    checkpoint: str,
    name: str,
    label: str = CSV_LABEL,
    **options,
) -> StreamingQuery:
    """Start the stream over everything available now. ``name`` must be unique among the
    streams and loads that write these tables, because a restarted stream clears what it left
    under its name; ``options`` go to :func:`run_batch`."""
    use_utc(records.sparkSession)

    def store(batch: DataFrame, number: int) -> None:
        run_batch(
            batch.sparkSession,
            Source(batch, label),
            tables,
            batch_id=f"{name}-{number:010d}",
            owner=f"stream {name}",
            **options,
        )

    return (
        records.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
