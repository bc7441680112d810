from pyspark.sql import functions as F
from txnmill.plans import incremental
from txnmill.plans.incremental import run_batch
from txnmill.plans.tables import Tables
from txnmill.sinks.tables import export_csv
from txnmill.sources.records import PAGES_LABEL, Source, read_csv
from txnmill.streaming import ingest

from test_loads import content, ids, txn

PARTS = [
    [txn(1, 1), txn(2, 2), txn(9, 2, amount="x"), txn(3, 3, transaction_id=" txn-3 ")],
    [txn(2, 2), txn(4, 3, merchant_name="M3"), txn(5, 1), txn(6, 4, merchant_name="M6"), txn(7, 4, merchant_name="M6")],
    [txn(8, 1, merchant_name="M1"), txn(10, 20)],
]


def run_stream(spark, tables, folder, **options):
    stream = ingest.read_csv_stream(spark, f"{folder}/files/*")
    query = ingest.start_ingest(stream, tables, f"{folder}/checkpoint", name="s", label="test", **options)
    query.awaitTermination()
    # The stream writes in a session of its own; this one may still list replaced files.
    for name in (tables.landing, tables.quarantine, tables.bronze):
        spark.catalog.refreshTable(name)


def test_stream_equals_batches(spark, records, tables, schema, tmp_path):
    spark.sql(f"CREATE DATABASE {schema}_batch")
    batch_tables = Tables.in_schema(f"{schema}_batch")
    for number, part in enumerate(PARTS):
        folder = f"{tmp_path}/files/{number}"
        export_csv(records(*part).coalesce(1), folder)
        run_stream(spark, tables, tmp_path)
        run_batch(spark, Source(read_csv(spark, folder), "test"), batch_tables, f"b-{number}")
    assert content(spark, tables) == content(spark, batch_tables)
    # Late rows (day 1 in the last part) are kept.
    assert "TXN-8" in ids(spark, tables.bronze, "is_duplicate")


def test_a_batch_delivered_twice_is_stored_once(spark, records, tables, tmp_path, monkeypatch):
    export_csv(records(*PARTS[0]).coalesce(1), f"{tmp_path}/files/0")
    calls = []

    def store_then_fail(*args, **options):
        result = run_batch(*args, **options)
        calls.append(options["batch_id"])
        if len(calls) == 1:
            raise RuntimeError("lost after storing")
        return result

    monkeypatch.setattr(ingest, "run_batch", store_then_fail)
    try:
        run_stream(spark, tables, tmp_path)
        raise AssertionError("the first attempt should fail")
    except Exception as error:
        assert "lost after storing" in str(error)
    before = content(spark, tables)
    run_stream(spark, tables, tmp_path)
    assert calls == ["s-0000000000", "s-0000000000"]
    assert content(spark, tables) == before


def test_header_in_another_order(spark, records, tables, tmp_path):
    frame = records(*PARTS[0])
    export_csv(frame.select("amount", F.lit("x").alias("extra"), *reversed(frame.drop("amount").columns)), f"{tmp_path}/files/0")
    run_stream(spark, tables, tmp_path)
    assert ids(spark, tables.bronze) == ["TXN-1", "TXN-2", "TXN-3"]


def test_files_with_another_header_fail_the_stream(spark, records, tables, tmp_path):
    export_csv(records(*PARTS[0]).coalesce(1), f"{tmp_path}/files/0")
    folder = tmp_path / "files" / "1"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("amount,transaction_id\n1.00,TXN-1\n")
    try:
        run_stream(spark, tables, tmp_path)
        raise AssertionError("expected a failure")
    except Exception as error:
        assert "header" in str(error).lower()


def test_json_lines_stream(spark, records, tables, tmp_path):
    records(*PARTS[0]).write.json(f"{tmp_path}/lines")
    stream = ingest.read_json_lines_stream(spark, f"{tmp_path}/lines", files_per_batch=2)
    ingest.start_ingest(stream, tables, f"{tmp_path}/cp", name="j", label=PAGES_LABEL).awaitTermination()
    assert ids(spark, tables.landing) == ["TXN-1", "TXN-2", "TXN-3", "TXN-9"]
    assert ids(spark, tables.quarantine) == ["TXN-9"]
    assert incremental.read_watermark(spark, tables).isEmpty()
