"""Source records from CSV files or downloaded JSON pages, every field as text.

Header-named CSV with quoted line breaks and array pages cannot be split inside a
file, so read parallelism is one task per file: keep files moderate, and pass
``multi_line=False`` / ``json_lines=True`` where the data allows it, which
:func:`read_source` and the jobs do too.
"""

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmill.functions.times import parse_iso_lenient
from txnmill.schema import RECORD_FIELDS, RECORD_SCHEMA

if TYPE_CHECKING:
    from txnmill.sources.ledger import Ledger

# With enforceSchema off, a file whose header differs from the others fails the query
# instead of landing its values in the wrong fields.
CSV_OPTIONS = {"header": True, "encoding": "UTF-8", "escape": '"', "enforceSchema": False}

# Column with the file of a record, where it is wanted.
SOURCE_FILE = "source_file"

CSV_LABEL = "csv_files"
PAGES_LABEL = "json_pages"


def read_csv(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, with_file: bool = False
) -> DataFrame:
    """CSV with a header row. Fields are found by their header name, wherever they
    stand; other columns are dropped and absent ones are null."""
    return by_name(spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).csv(path), with_file)


def by_name(raw: DataFrame, with_file: bool = False) -> DataFrame:
    """The ten fields of a frame that may have them anywhere, lack some or have others."""
    position = {name: i for i, name in enumerate(raw.columns)}
    last = len(raw.columns)
    by_position = raw.select("*", *_file(with_file)).toDF(*[f"c{i}" for i in range(last + with_file)])
    fields = [
        (F.col(f"c{position[name]}") if name in position else F.lit(None).cast("string")).alias(name)
        for name in RECORD_FIELDS
    ]
    return by_position.select(*fields, *([F.col(f"c{last}").alias(SOURCE_FILE)] if with_file else []))


def _file(wanted: bool) -> list[Column]:
    return [F.col("_metadata.file_path").alias(SOURCE_FILE)] if wanted else []


# A field that is a number: from_json would write the number anew, as text it keeps its form. Quotes inside of
# strings are escaped in JSON, so a bare field name between two quotes is a key or a whole value, and only a key
# has a colon after it.
_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|NaN|[+-]?INF|[+-]?Infinity"
_NUMBER_FIELD = rf'"({"|".join(RECORD_FIELDS)})"(\s*:\s*)({_NUMBER})(?=\s*[,}}])'


def read_json_pages(
    spark: SparkSession, path: str | list[str], json_lines: bool = False, with_file: bool = False
) -> DataFrame:
    """Downloaded result pages: one JSON array of records per file, or one record per line.

    A page that is not one array of objects fails the query rather than landing as rows of nulls or as
    a part of what it holds. Numbers keep the text they have in the file, in both forms. Array pages are
    read once, each as one text in one task.
    """
    if json_lines:
        lines = spark.read.schema(RECORD_SCHEMA).option("mode", "FAILFAST").json(path)
        return lines.select("*", *_file(with_file))
    return page_records(spark.read.text(path, wholetext=True).select("value", *_file(with_file)))


def page_records(pages: DataFrame) -> DataFrame:
    """Records of pages that are given as text in the column ``value``, with the other columns there are.

    A page is parsed as the only element of an array, so that the parser sees what follows it.
    """
    page = F.col("value")
    wrong = F.concat(F.lit("page is not a JSON array: "), F.substring(page, 1, 80))
    starts_well = F.substring(F.ltrim(page, F.lit(" \t\r\n")), 1, 1) == "["
    text = F.concat(F.lit("["), F.regexp_replace(page, _NUMBER_FIELD, '"$1"$2"$3"'), F.lit("]"))
    kind = T.ArrayType(T.ArrayType(RECORD_SCHEMA))
    parsed = F.from_json(F.when(starts_well, text).otherwise(F.raise_error(wrong)), kind, {"mode": "FAILFAST"})
    others = [name for name in pages.columns if name != "value"]
    read = pages.select("*", parsed.alias("arrays"))
    one = (F.size("arrays") == 1) & ~F.exists(F.element_at("arrays", 1), lambda record: record.isNull())
    records = F.inline(F.when(one, F.element_at("arrays", 1)).otherwise(F.raise_error(wrong)))
    return read.select(records, *others)


def since(records: DataFrame, bound: str | None) -> DataFrame:
    """Records dated at or after ``bound`` (ISO-Z text). Without a bound all pass;
    with one, records whose date cannot be read are left out."""
    if bound is None:
        return records
    return records.filter(
        parse_iso_lenient(F.col("transaction_date")) >= parse_iso_lenient(F.lit(bound))
    )


@dataclass(frozen=True)
class Source:
    """Records plus the label of the source they were really read from. ``seen`` has the number
    of records before the time bound as ``n`` once the records have been read."""

    records: DataFrame
    label: str
    seen: Observation | None = None
    ledger: "Ledger | None" = None  # of the files that were opened, see sources/ledger.py


def bounded(records: DataFrame, label: str, bound: str | None) -> Source:
    """A source of the records since ``bound``, which counts those that the bound leaves out."""
    if bound is None:
        return Source(records, label)
    seen = Observation()
    return Source(since(records.observe(seen, F.count(F.lit(1)).alias("n")), bound), label, seen)


def read_source(
    spark: SparkSession,
    pages_path: str | None,
    csv_path: str,
    bound: str | None = None,
    multi_line: bool = True,
    json_lines: bool = False,
) -> Source:
    """Pages if they are there, else CSV. The choice is made when the path is resolved;
    a page that turns out to be broken later fails the load."""
    if pages_path is not None:
        try:
            return bounded(read_json_pages(spark, pages_path, json_lines), PAGES_LABEL, bound)
        except AnalysisException:
            pass
    return bounded(read_csv(spark, csv_path, multi_line), CSV_LABEL, bound)
