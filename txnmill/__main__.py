"""Jobs for spark-submit.

    python -m txnmill full        --schema bank --csv /data/in --pages /data/pages
    python -m txnmill incremental --schema bank --csv /data/in
    python -m txnmill stream      --schema bank --csv /data/in --checkpoint /data/cp
    python -m txnmill compact     --schema bank
    python -m txnmill refresh     --schema bank --summary bank.daily_incremental
    python -m txnmill summary     --bronze bank.bronze_transactions --summary bank.daily
"""

import argparse
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from txnmill.operators import quality, routing
from txnmill.plans.compaction import compact
from txnmill.plans.full_load import full_load, load_counts
from txnmill.plans.incremental import LOOKBACK_DAYS, incremental_load
from txnmill.plans.published import create_views
from txnmill.plans.summary import rebuild_summary, refresh_summary
from txnmill.plans.tables import Tables
from txnmill.session import use_utc
from txnmill.sources.ledger import read_new_files
from txnmill.sources.records import CSV_LABEL, PAGES_LABEL, Source, read_source
from txnmill.streaming.ingest import read_csv_stream, read_json_lines_stream, start_ingest


def _show(title: str, rows: DataFrame) -> None:
    print(title)
    rows.show(truncate=False)


def _source(spark: SparkSession, args: argparse.Namespace, bound: str | None = None) -> Source:
    return read_source(
        spark, args.pages, args.csv, bound, multi_line=not args.csv_lines, json_lines=args.json_lines
    )


def _new_files(spark: SparkSession, args: argparse.Namespace, ledger: str, bound: str | None) -> Source:
    """What the ledger says has to be opened, of the pages if they are there, else of the CSV files."""
    read = partial(read_new_files, spark, ledger, bound=bound, multi_line=not args.csv_lines, json_lines=args.json_lines)
    if args.pages:
        try:
            return read(args.pages, pages=True)
        except AnalysisException:
            pass
    return read(args.csv)


def _full(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = Tables.in_schema(args.schema)
    source = _source(spark, args)
    _show("Counts", quality.reconcile(full_load(spark, source, tables, table_format=args.format)))
    rejected, bronze = spark.table(tables.quarantine), spark.table(tables.bronze)
    _show("Quarantined", routing.sample_by_id(rejected, ["transaction_id", "error_reason"]))
    repeated = routing.duplicates(bronze)
    _show("Duplicates", routing.sample_by_id(repeated, ["transaction_id", "account_id", "amount"]))


def _incremental(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = Tables.in_schema(args.schema, "_incremental")
    result = incremental_load(
        spark,
        lambda bound: _new_files(spark, args, tables.files, bound) if args.ledger else _source(spark, args, bound),
        tables,
        lookback_days=args.lookback_days,
        batch_id=args.batch_id,
        owner=args.owner,
    )
    print(result)
    _show("Counts of this batch", load_counts(spark, tables, result.batch_id))


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = Tables.in_schema(args.schema, "_incremental")
    if args.json_lines:
        records, label = read_json_lines_stream(spark, args.pages or args.csv), PAGES_LABEL
    else:
        records, label = read_csv_stream(spark, args.csv, multi_line=not args.csv_lines), CSV_LABEL
    start_ingest(records, tables, args.checkpoint, args.name, label).awaitTermination()


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    print("Folded into", compact(spark, Tables.in_schema(args.schema, "_incremental")))


def _refresh(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = Tables.in_schema(args.schema, "_incremental")
    print("Views", ", ".join(create_views(spark, tables)))
    print("Days replaced:", refresh_summary(spark, tables, args.summary))


def _summary(spark: SparkSession, args: argparse.Namespace) -> None:
    rebuild_summary(spark, args.bronze, args.summary, table_format=args.format)
    days = spark.table(args.summary)
    checks = {
        "null fields": quality.null_fields(days),
        "repeated days": quality.repeated_days(days),
        "wrong net amounts": quality.wrong_net(days),
        "days without transactions": quality.empty_days(days),
    }
    for title, broken in checks.items():
        print(f"{title}: {'none' if broken.isEmpty() else 'FOUND'}")


def main() -> None:
    parser = argparse.ArgumentParser(prog="txnmill")
    jobs = parser.add_subparsers(required=True)
    for name, run in (("full", _full), ("incremental", _incremental), ("stream", _stream)):
        job = jobs.add_parser(name)
        job.set_defaults(run=run)
        job.add_argument("--schema", required=True, help="catalog schema of the tables")
        job.add_argument("--csv", required=name != "stream", help="folder of CSV files")
        job.add_argument("--csv-lines", action="store_true", help="no line breaks in values: files are split")
        job.add_argument("--json-lines", action="store_true", help="a record per line: files are split")
        job.add_argument("--pages", help="folder of JSON pages; preferred if it exists")
        if name == "full":
            job.add_argument("--format", default="parquet", help="table format, e.g. delta")
        if name == "stream":
            job.add_argument("--checkpoint", required=True)
            job.add_argument("--name", default="stream")
        if name == "incremental":
            job.add_argument("--lookback-days", type=int, default=LOOKBACK_DAYS)
            job.add_argument("--batch-id", help="of a run to repeat")
            job.add_argument("--ledger", action="store_true", help="open only files that are new or reach past the bound")
            job.add_argument("--owner", help="name of this job; its next run clears what a dead one left")
    job = jobs.add_parser("compact")
    job.set_defaults(run=_compact)
    job.add_argument("--schema", required=True)
    job = jobs.add_parser("refresh")
    job.set_defaults(run=_refresh)
    job.add_argument("--schema", required=True)
    job.add_argument("--summary", required=True, help="table that is kept up to date batch by batch")
    job = jobs.add_parser("summary")
    job.set_defaults(run=_summary)
    job.add_argument("--bronze", required=True)
    job.add_argument("--summary", required=True)
    job.add_argument("--format", default="parquet")
    args = parser.parse_args()
    args.run(use_utc(SparkSession.builder.appName("txnmill").getOrCreate()), args)


if __name__ == "__main__":
    main()
