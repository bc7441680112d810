"""Which files of a source a run has to open.

The ledger has an entry for every file that was read: its size and time of modification, the bound it was read
with, and the least and greatest date of its records since that bound. A run lists the files, which opens none, and
opens those that are new or have changed, and those that reach past its bound. What it leaves closed are files
that have not changed and have nothing but records before the bound, which an incremental read leaves out anyway.

An entry is added when the records it tells of have landed. If a run dies before that, or another one lands
first, the files are new to the next run: a missing entry costs time and no record. A file that changes after it
was listed has another time of modification next time. Of several entries of one file the last counts.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmill.functions.times import parse_iso, parse_iso_lenient
from txnmill.schema import LEDGER_SCHEMA, RECORD_SCHEMA
from txnmill.sinks.log import append_to_log, fold_log, latest_epoch, read_log
from txnmill.sources.records import (
    CSV_LABEL,
    PAGES_LABEL,
    SOURCE_FILE,
    Source,
    bounded,
    read_csv,
    read_json_pages,
)

# Files that are opened one by one; if a run needs more of them, it reads the whole source.
MOST_PATHS = 50_000
# Appends that lie in files of their own before they are folded into one file.
TAIL_APPENDS = 64


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, path, size, modified) of the files a read of ``path`` would take. None is opened."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        "path",
        F.col("length").alias("size"),
        F.unix_millis("modificationTime").alias("modified"),
    )


def known_files(spark: SparkSession, ledger: str) -> DataFrame:
    """The last entry of every file."""
    entry = F.struct("size", "modified", "read_from", "greatest")
    return read_log(spark, ledger, LEDGER_SCHEMA).groupBy(SOURCE_FILE).agg(
        F.max_by(entry, F.struct("number", "modified")).alias("entry")
    )


def _needed(bound: str | None) -> tuple[Column, Column]:
    """Whether a file is new or changed, or was not read as far back; and whether it reaches past the bound."""
    entry = F.col("entry")
    unchanged = (entry["size"] == F.col("size")) & (entry["modified"] == F.col("modified"))
    if bound is None:
        as_far_back = entry["read_from"].isNull()
        return ~F.coalesce(unchanged & as_far_back, F.lit(False)), F.lit(True)
    since = parse_iso(F.lit(bound))
    as_far_back = F.coalesce(parse_iso(entry["read_from"]) <= since, F.lit(True))
    reaches = F.coalesce(entry["greatest"] >= since, F.lit(False))
    return ~F.coalesce(unchanged & as_far_back, F.lit(False)), reaches


def files_to_open(files: DataFrame, known: DataFrame, bound: str | None) -> DataFrame:
    """Listed files that a read since ``bound`` needs; ``is_new`` tells for which an entry is due."""
    is_new, reaches = _needed(bound)
    return (
        files.join(known, SOURCE_FILE, "left")
        .withColumn("is_new", is_new)
        .filter(F.col("is_new") | reaches)
        .drop("entry")
    )


def _literal(path: str) -> str:
    """A path whose characters are taken as they are, not as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_new_files(
    spark: SparkSession,
    ledger: str,
    path: str,
    bound: str | None = None,
    pages: bool = False,
    multi_line: bool = True,
    json_lines: bool = False,
    most_paths: int = MOST_PATHS,
) -> Source:
    """Records since ``bound`` of the CSV files (or JSON pages) under ``path`` that have to be opened."""
    files = listed_files(spark, path)
    needed = files_to_open(files, known_files(spark, ledger), bound)
    # As many short rows at most as files may be opened one by one, and one more.
    rows = needed.select(SOURCE_FILE, "path", "size", "modified", "is_new").limit(most_paths + 1).collect()
    paths = [_literal(row["path"]) for row in rows] if len(rows) <= most_paths else path
    label = PAGES_LABEL if pages else CSV_LABEL
    if not rows:
        schema = T.StructType([*RECORD_SCHEMA, T.StructField(SOURCE_FILE, T.StringType())])
        records = spark.createDataFrame([], schema)
    elif pages:
        records = read_json_pages(spark, paths, json_lines, with_file=True)
    else:
        records = read_csv(spark, paths, multi_line, with_file=True)
    source = bounded(records, label, bound)
    due: DataFrame | None = needed.filter("is_new").select(SOURCE_FILE, "size", "modified")
    if len(rows) <= most_paths:
        # as they were seen now, not as the ledger is when the entries are made
        new = [(row[SOURCE_FILE], row["size"], row["modified"]) for row in rows if row["is_new"]]
        due = spark.createDataFrame(new, due.schema) if new else None
    return Source(source.records, source.label, source.seen, Ledger(ledger, due, bound))


class Ledger:
    """Entries that are due once the records of the files have landed; ``due`` is None without new files."""

    def __init__(self, name: str, due: DataFrame | None, bound: str | None):
        self.name, self.due, self.bound = name, due, bound

    def enter(self, staged: DataFrame, number: int) -> None:
        """Add the entries; ``staged`` has the records as they were read, with their file."""
        if self.due is None:
            return
        date = parse_iso_lenient(F.col("transaction_date"))
        found = staged.groupBy(SOURCE_FILE).agg(
            F.count(F.lit(1)).alias("rows"), F.min(date).alias("least"), F.max(date).alias("greatest")
        )
        entries = self.due.join(found, SOURCE_FILE, "left").withColumns(
            {
                "number": F.lit(number).cast("long"),
                "read_from": F.lit(self.bound).cast("string"),
                "rows": F.coalesce("rows", F.lit(0)),
            }
        )
        append_to_log(staged.sparkSession, self.name, LEDGER_SCHEMA, entries)

    def fold_if_long(self, spark: SparkSession, number: int) -> None:
        """Keep the last entry of every file in one file, if many came since that was done. Only for a run that
        has opened its batch, as for the control table."""
        epoch = latest_epoch(spark, self.name)
        if number - epoch < TAIL_APPENDS:
            return
        rows = read_log(spark, self.name, LEDGER_SCHEMA)
        entry = F.struct(*LEDGER_SCHEMA.names)
        last = rows.groupBy(SOURCE_FILE).agg(F.max_by(entry, F.struct("number", "modified")).alias("entry"))
        if not rows.isEmpty():
            fold_log(spark, self.name, LEDGER_SCHEMA, last.select("entry.*"), number)
