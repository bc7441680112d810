"""One query per operator, over all records derived from the ``events`` table.

Queries that exercise files, tables or streams write below the shared folder, in a new
subfolder and database per call, and return what they read back. Clock columns are left
out of results. Where an operator needs two loads, the first gets the originals dated
before a day and the second gets everything.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.records import landed_fields, source_records
from txnmill.operators import increment, landing, quality, repeats, routing, rules, summary
from txnmill.plans import batches, incremental
from txnmill.plans.compaction import compact
from txnmill.plans.full_load import full_load, load_counts
from txnmill.plans.published import create_views
from txnmill.plans.summary import rebuild_summary, refresh_summary
from txnmill.plans.tables import Tables
from txnmill.profiles import FULL, INCREMENTAL, Profile
from txnmill.schema import BRONZE_COLUMNS, LANDING_FIELDS, QUARANTINE_COLUMNS, STAMP_FIELDS, VALID_COLUMNS
from txnmill.session import shared_dir, use_utc
from txnmill.sinks.tables import add_batch, append_if_not_empty, export_csv
from txnmill.sources.ledger import read_new_files
from txnmill.sources.records import (
    PAGES_LABEL,
    Source,
    read_csv,
    read_json_pages,
    read_source,
    since,
)
from txnmill.functions.typed import account_number, computed_once, with_typed_columns
from txnmill.streaming.ingest import read_csv_stream, start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_PART = "transaction_date < '2024-01-20' AND transaction_id NOT LIKE '%D'"
LOADED_AT = "2024-06-01T00:00:00Z"
FEW = 2  # as many rows make a key heavy in the checks of the path for heavy keys


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Shared inputs -------------------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return landing.land(source_records(spark, sf_dir), profile)


def _validated(spark: SparkSession, sf_dir: str, profile: Profile = FULL) -> DataFrame:
    landed = _landed(spark, sf_dir, profile)
    return rules.validate(computed_once(landed) if profile.cleans_text else landed, profile)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.mark_duplicates(routing.valid(_validated(spark, sf_dir)))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.summary_base(_bronze(spark, sf_dir))


def _is_first_part() -> F.Column:
    return F.coalesce(F.expr(FIRST_PART), F.lit(False))


def _workspace(spark: SparkSession) -> tuple[str, str]:
    """A new folder and a database located in it."""
    name = f"check_{uuid.uuid4().hex[:12]}"
    folder = f"{shared_dir(use_utc(spark))}/txnmill-checks/{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/tables'")
    return name, folder


def _write_csv(records: DataFrame, folder: str) -> str:
    export_csv(records, folder)
    return folder


# Sources -------------------------------------------------------------------------------


@query
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = _workspace(spark)
    path = _write_csv(source_records(spark, sf_dir), f"{folder}/csv")
    return landing.land(read_csv(spark, path), FULL)


@query
def scan_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = since(source_records(spark, sf_dir), "2024-01-15T00:00:00Z")
    return landing.land(records, FULL)


PAGE_ROWS = 1000


@query
def scan_json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of at most 1000 consecutive records, one JSON array to a file."""
    _, folder = _workspace(spark)
    records = _records_with_large_amounts(spark, sf_dir)
    page = F.floor(F.monotonically_increasing_id() / PAGE_ROWS)
    pages = (
        records.select(page.alias("page"), _as_json(records).alias("record"))
        .groupBy("page")
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ",\n"), F.lit("]")).alias("value"))
        .select("value")
    )
    pages.write.option("maxRecordsPerFile", 1).text(f"{folder}/pages")
    return landing.land(read_json_pages(spark, f"{folder}/pages"), FULL)


@query
def scan_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records, one to a line of files that can be split."""
    _, folder = _workspace(spark)
    records = _records_with_large_amounts(spark, sf_dir)
    records.select(_as_json(records)).write.text(f"{folder}/lines")
    return landing.land(read_json_pages(spark, f"{folder}/lines", json_lines=True), FULL)


def _records_with_large_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts in cents that end in 7 are moved to ten millions and beyond."""
    amount = F.col("amount")
    plain = amount.rlike(r"^\d+\.\d\d$") & amount.endswith("7")
    large = F.concat(F.lit("1234567"), F.lpad(amount, 10, "0"))
    return source_records(spark, sf_dir).withColumn("amount", F.when(plain, large).otherwise(amount))


def _as_json(records: DataFrame) -> F.Column:
    """A record as the interface writes it: amounts are numbers wherever they can be."""
    others = F.to_json(F.struct(*(c for c in records.columns if c != "amount")))
    amount = F.col("amount")
    text = F.coalesce(F.when(amount.rlike(r"^-?\d+(\.\d+)?$"), amount), F.concat(F.lit('"'), amount, F.lit('"')))
    field = F.coalesce(F.concat(F.lit(',"amount":'), text), F.lit(""))
    return F.concat(F.rtrim(others, F.lit("}")), field, F.lit("}"))


@query
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = _workspace(spark)
    path = _write_csv(source_records(spark, sf_dir), f"{folder}/csv")
    source = read_source(spark, f"{folder}/no-pages-here", path)
    return landing.land(source.records, FULL).withColumn("source_system", F.lit(source.label))


# Landing and typing --------------------------------------------------------------------


@query
def landing_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = landing.stamp(_landed(spark, sf_dir, FULL), PAGES_LABEL, LOADED_AT)
    return stamped.drop("ingestion_timestamp")


@query
def landing_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = landing.stamp(_landed(spark, sf_dir, INCREMENTAL), PAGES_LABEL, LOADED_AT)
    return stamped.drop("ingestion_timestamp")


@query
def typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_typed_columns(_landed(spark, sf_dir, FULL)).select(
        "transaction_id",
        "amount",
        "transaction_ts",
        account_number(F.col("account_id")).alias("account_number"),
    )


# Rules ---------------------------------------------------------------------------------

RULE_QUERIES = {
    "rule_transaction_id": "err_transaction_id",
    "rule_account_id": "err_account_id",
    "rule_date_format": "err_transaction_date_format",
    "rule_date_value": "err_transaction_date_value",
    "rule_date_range": "err_transaction_date_range",
    "rule_amount": "err_amount",
    "rule_currency": "err_currency",
    "rule_transaction_type": "err_transaction_type",
    "rule_merchant_name": "err_merchant_name",
    "rule_merchant_category": "err_merchant_category",
    "rule_status": "err_status",
    "rule_country_code": "err_country_code",
}


def _rule_query(column: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        by_profile = [
            rules.with_rule_messages(_landed(spark, sf_dir, profile), profile).select(
                "transaction_id",
                "account_id",
                F.lit(profile.name).alias("profile"),
                F.col(column).alias("message"),
            )
            for profile in (FULL, INCREMENTAL)
        ]
        return by_profile[0].unionByName(by_profile[1])

    return run


QUERIES.update({name: _rule_query(column) for name, column in RULE_QUERIES.items()})


@query
def error_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select(
        "transaction_id",
        "account_id",
        F.array_join("error_array", "|").alias("messages"),
        F.size("error_array").cast("long").alias("n"),
    )


VALIDATED_COLUMNS = [*LANDING_FIELDS, "amount", "transaction_ts", "error_reason", "is_valid"]


@query
def validate_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select(VALIDATED_COLUMNS)


@query
def validate_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir, INCREMENTAL).select(VALIDATED_COLUMNS)


# Routing -------------------------------------------------------------------------------


@query
def quarantine_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.quarantined(_validated(spark, sf_dir))


@query
def quarantine_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.quarantined(_validated(spark, sf_dir, INCREMENTAL))


@query
def valid_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.valid(_validated(spark, sf_dir))


@query
def valid_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.valid(_validated(spark, sf_dir, INCREMENTAL))


@query
def quarantine_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.sample_by_id(
        quarantine_full(spark, sf_dir), ["transaction_id", "error_reason"]
    )


# Duplicates ----------------------------------------------------------------------------


@query
def mark_duplicates_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir)


@query
def duplicates_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.duplicates(_bronze(spark, sf_dir))


@query
def unique_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.unique(_bronze(spark, sf_dir))


@query
def duplicate_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.sample_by_id(
        duplicates_only(spark, sf_dir), ["transaction_id", "account_id", "amount"]
    )


@query
def natural_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = repeats.natural_key_text(valid_full(spark, sf_dir))
    return keyed.select("transaction_id", "natural_key")


@query
def existing_natural_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.known_keys(_bronze(spark, sf_dir))


@query
def existing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increment.known_ids(_landed(spark, sf_dir, FULL))


def _two_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows of the first load, and valid rows of everything else."""
    validated = _validated(spark, sf_dir, INCREMENTAL)
    first = routing.valid(validated.filter(_is_first_part()))
    return first, routing.valid(validated.filter(~_is_first_part()))


@query
def new_rows_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed(spark, sf_dir, INCREMENTAL)
    known = increment.known_ids(landed.filter(_is_first_part()))
    return increment.new_rows(landed, known)


@query
def new_rows_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path for ids that very many rows share, here two."""
    landed = _landed(spark, sf_dir, INCREMENTAL)
    known = increment.known_ids(landed.filter(_is_first_part()))
    return increment.new_rows(landed, known, heavy_rows=FEW)


@query
def known_ids_uncleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows of the incremental profile against history that was landed as it came, by both
    ways of :func:`drop_known`."""
    history = _landed(spark, sf_dir, FULL).filter(_is_first_part())
    padded = F.concat(F.lit("  "), F.lower("transaction_id"), F.lit(" "))
    history = history.withColumn("transaction_id", padded)
    landed = _landed(spark, sf_dir, INCREMENTAL)
    ways = [
        incremental.drop_known(landed, history, row_count=1, broadcast_bytes=limit).select(
            F.lit(limit).cast("long").alias("broadcast_bytes"), *LANDING_FIELDS
        )
        for limit in (0, 2**20)
    ]
    return ways[0].unionByName(ways[1])


@query
def existing_duplicate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, rest = _two_parts(spark, sf_dir)
    known = repeats.known_keys(first)
    return repeats.with_seen_before(rest, known)


@query
def mark_duplicates_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, rest = _two_parts(spark, sf_dir)
    return repeats.mark_duplicates(rest, first)


@query
def mark_duplicates_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path for keys that very many rows share, here two."""
    return repeats.mark_duplicates(routing.valid(_validated(spark, sf_dir)), heavy_rows=FEW)


@query
def mark_duplicates_incremental_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, rest = _two_parts(spark, sf_dir)
    return repeats.mark_duplicates(rest, first, heavy_rows=FEW)


# Summary -------------------------------------------------------------------------------


@query
def summary_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir)


@query
def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.daily_metrics(_base(spark, sf_dir)).drop("currencies")


@query
def daily_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = summary.daily_metrics(_base(spark, sf_dir))
    return metrics.select("account_id", "transaction_date", "currencies")


@query
def category_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.category_spend(_base(spark, sf_dir))


@query
def ranked_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.ranked_categories(category_spend(spark, sf_dir))


@query
def top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.top_category(ranked_categories(spark, sf_dir))


@query
def daily_account_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.daily_summary(_base(spark, sf_dir))


@query
def daily_summary_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary from two parts by a join on account and day."""
    base = _base(spark, sf_dir)
    top = summary.top_category(summary.ranked_categories(summary.category_spend(base)))
    return summary.daily_metrics(base).join(top, summary.ACCOUNT_DAY, "left").select(summary.SUMMARY_COLUMNS)


# Counts and checks ---------------------------------------------------------------------


@query
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the tables that a full load has written."""
    return load_counts(spark, _full_load(spark, sf_dir))


@query
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile(run_metrics(spark, sf_dir))


def _faulty_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary with faults planted by day: nulls, wrong nets, no transactions, days twice."""
    day = F.dayofmonth("transaction_date")
    rows = daily_account_summary(spark, sf_dir).withColumns(
        {
            "top_category": F.when(day % 7 != 0, F.col("top_category")),
            "net_amount": F.when(day % 5 == 0, F.col("net_amount") + F.lit(1)).otherwise(F.col("net_amount")).cast("decimal(18,2)"),
            "transaction_count": F.when(day % 11 == 0, F.lit(0)).otherwise(F.col("transaction_count")).cast("long"),
        }
    )
    return rows.withColumn("copy", F.explode(F.when(day % 13 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("copy")


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_fields(_faulty_summary(spark, sf_dir))


@query
def dq_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_days(_faulty_summary(spark, sf_dir))


@query
def dq_net_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.wrong_net(_faulty_summary(spark, sf_dir))


@query
def dq_positive_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.empty_days(_faulty_summary(spark, sf_dir))


# Incremental loads ---------------------------------------------------------------------


@query
def max_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increment.max_event_time(_bronze(spark, sf_dir))


@query
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a read since the last event time leaves out, among them such as only a strict
    reading or none can date."""
    dated = F.col("transaction_date")
    spoilt = F.when(dated.endswith("7Z"), F.replace(dated, F.lit("-0"), F.lit("-"))).when(
        dated.endswith("9Z"), F.concat(F.lit("on "), dated)
    )
    landed = _landed(spark, sf_dir, FULL).withColumn("transaction_date", F.coalesce(spoilt, dated))
    return increment.late_rows(landed, increment.max_event_time(_bronze(spark, sf_dir)))


def _run(spark: SparkSession, tables: Tables, records: DataFrame, batch_id: str) -> None:
    incremental.incremental_load(
        spark,
        lambda bound: Source(since(records, bound), PAGES_LABEL),
        tables,
        batch_id=batch_id,
        loaded_at=LOADED_AT,
    )


def _first_run(spark: SparkSession, sf_dir: str) -> tuple[Tables, DataFrame]:
    schema, _ = _workspace(spark)
    tables = Tables.in_schema(schema)
    records = source_records(spark, sf_dir)
    _run(spark, tables, records.filter(_is_first_part()), "run1")
    return tables, records


def _two_runs(spark: SparkSession, sf_dir: str) -> Tables:
    tables, records = _first_run(spark, sf_dir)
    _run(spark, tables, records, "run2")
    return tables


def _run_number() -> F.Column:
    return F.right(F.col("batch_id"), F.lit(1)).cast("int")


def _without_stamps(columns: list[str]) -> list[str]:
    return [name for name in columns if name not in STAMP_FIELDS]


@query
def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = _first_run(spark, sf_dir)
    return incremental.read_watermark(spark, tables).select(
        "last_successful_watermark", "rows_processed", "lookback_days"
    )


@query
def effective_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = _first_run(spark, sf_dir)
    state = incremental.read_watermark(spark, tables)
    return increment.with_effective_bound(state).select("effective_watermark")


@query
def next_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = incremental.read_watermark(spark, _two_runs(spark, sf_dir))
    return state.select("last_successful_watermark")


@query
def incremental_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = spark.table(_two_runs(spark, sf_dir).bronze)
    return bronze.select(_run_number().alias("run"), *_without_stamps(BRONZE_COLUMNS))


@query
def incremental_by_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both runs over a folder that grows, with files by date; the second opens those it has to."""
    schema, folder = _workspace(spark)
    tables = Tables.in_schema(schema)
    records = source_records(spark, sf_dir)
    for batch_id, condition in (("run1", _is_first_part()), ("run2", ~_is_first_part())):
        part = records.filter(condition).repartitionByRange(LEDGER_FILES, "transaction_date")
        part.select(_as_json(part)).write.mode("append").text(f"{folder}/lines")
        incremental.incremental_load(
            spark,
            lambda bound: read_new_files(
                spark, tables.files, f"{folder}/lines", bound, pages=True, json_lines=True
            ),
            tables,
            batch_id=batch_id,
            loaded_at=LOADED_AT,
        )
    bronze = spark.table(tables.bronze)
    return bronze.select(_run_number().alias("run"), *_without_stamps(BRONZE_COLUMNS))


LEDGER_FILES = 12


@query
def incremental_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the control table says of a first run, one without any row, and a normal one."""
    tables, records = _first_run(spark, sf_dir)
    _run(spark, tables, records.limit(0), "run2")
    _run(spark, tables, records, "run3")
    ended = batches.events(spark, tables).filter(F.col("status") != batches.OPEN)
    return ended.select(_run_number().alias("run"), "status", "read_rows", "new_rows", "last_successful_watermark")


@query
def incremental_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both runs once more under their ids, with other input: nothing may change."""
    tables, records = _first_run(spark, sf_dir)
    _run(spark, tables, records, "run1")
    _run(spark, tables, records, "run2")
    _run(spark, tables, records.limit(0), "run2")
    bronze = spark.table(tables.bronze)
    return bronze.select(_run_number().alias("run"), *_without_stamps(BRONZE_COLUMNS))


@query
def incremental_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both runs folded into one batch, and the second run once more."""
    tables, records = _first_run(spark, sf_dir)
    _run(spark, tables, records, "run2")
    compact(spark, tables)
    _run(spark, tables, records, "run3")
    return spark.table(tables.bronze).select(_without_stamps(BRONZE_COLUMNS))


@query
def summary_after_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary that is brought up to date after each run."""
    tables, records = _first_run(spark, sf_dir)
    name = f"{tables.bronze.split('.')[0]}.daily"
    refresh_summary(spark, tables, name)
    _run(spark, tables, records, "run2")
    refresh_summary(spark, tables, name)
    return spark.table(name).select(summary.SUMMARY_COLUMNS)


@query
def published_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader sees of a landed run, a fold, one more landed run, and one that is still being written."""
    tables, records = _first_run(spark, sf_dir)
    compact(spark, tables)
    _run(spark, tables, records, "run2")
    add_batch(spark.table(tables.bronze).filter("batch_id = 'run2'").drop("batch_id"), tables.bronze, "run3", ["event_date"])
    view = create_views(spark, tables)[-1]
    return spark.table(view).select(_without_stamps(BRONZE_COLUMNS))


@query
def incremental_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = spark.table(_two_runs(spark, sf_dir).quarantine)
    return rejected.select(_run_number().alias("run"), *_without_stamps(QUARANTINE_COLUMNS))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the first part, then the other files, through one stream."""
    schema, folder = _workspace(spark)
    tables = Tables.in_schema(schema)
    records = source_records(spark, sf_dir)
    for part, condition in (("part1", _is_first_part()), ("part2", ~_is_first_part())):
        _write_csv(records.filter(condition), f"{folder}/files/{part}")
        stream = read_csv_stream(spark, f"{folder}/files/*")
        start_ingest(
            stream, tables, f"{folder}/checkpoint", name="files", loaded_at=LOADED_AT
        ).awaitTermination()
    batch = (_run_number() + 1).alias("batch")
    return spark.table(tables.bronze).select(batch, *_without_stamps(BRONZE_COLUMNS))


# Sinks ---------------------------------------------------------------------------------


def _full_load(spark: SparkSession, sf_dir: str) -> Tables:
    schema, _ = _workspace(spark)
    tables = Tables.in_schema(schema)
    full_load(spark, Source(source_records(spark, sf_dir), PAGES_LABEL), tables, LOADED_AT)
    return tables


@query
def sink_full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _full_load(spark, sf_dir)
    return spark.table(tables.bronze).select(_without_stamps(BRONZE_COLUMNS))


@query
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = _workspace(spark)
    first, rest = _two_parts(spark, sf_dir)
    for part in (first, rest, rest.filter("amount < 0")):
        append_if_not_empty(part, f"{schema}.appended")
    return spark.table(f"{schema}.appended")


@query
def sink_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _full_load(spark, sf_dir)
    name = f"{tables.bronze.split('.')[0]}.daily_account_summary"
    rebuild_summary(spark, tables.bronze, name)
    return spark.table(name).drop("updated_at")


@query
def export_csv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = _workspace(spark)
    export_csv(daily_account_summary(spark, sf_dir), f"{folder}/summary")
    return spark.read.csv(f"{folder}/summary", header=True)


QUERIES["export_csv"] = QUERIES.pop("export_csv_summary")


@query
def export_quarantine_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = _workspace(spark)
    export_csv(quarantine_full(spark, sf_dir), f"{folder}/quarantine")
    return spark.read.csv(f"{folder}/quarantine", header=True, escape='"')
