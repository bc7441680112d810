"""Files that a run has to open, and tables that are logs."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from conftest import GOOD
from test_loads import at, ids, txn
from txnmill.plans import batches, incremental
from txnmill.plans.batches import OpenBatchError
from txnmill.schema import CONTROL_SCHEMA, LEDGER_SCHEMA
from txnmill.sinks.log import append_to_log, epochs, fold_log, read_log
from txnmill.sources import ledger as ledgers
from txnmill.sources.ledger import read_new_files


def put(folder, name, *records, how="json"):
    """A file of records; later than all before it."""
    folder.mkdir(exist_ok=True)
    rows = [{**GOOD, **r} for r in records]
    if how == "csv":
        text = "\n".join([",".join(GOOD), *(",".join(r.values()) for r in rows)])
    else:
        text = "\n".join(map(json.dumps, rows)) if how == "lines" else json.dumps(rows)
    path = folder / name
    path.write_text(text + "\n")
    put.clock = getattr(put, "clock", time.time()) + 2
    os.utime(path, (put.clock, put.clock))


def load(spark, tables, folder, opened=None, how="json", most_paths=ledgers.MOST_PATHS, **options):
    def read(bound):
        kind = {"pages": how != "csv", "json_lines": how == "lines"}
        source = read_new_files(spark, tables.files, str(folder), bound, **kind, most_paths=most_paths)
        if opened is not None:
            opened.append(sorted(os.path.basename(f) for f in source.records.inputFiles()))
        return source

    return incremental.incremental_load(spark, read, tables, **options)


@pytest.mark.parametrize("how", ["json", "lines", "csv"])
def test_only_new_files_and_those_past_the_bound_are_opened(spark, tables, tmp_path, how):
    folder, opened = tmp_path / "in", []
    put(folder, "1", txn(1, 1), txn(2, 2), how=how)
    put(folder, "2", txn(3, 9), txn(4, 3), how=how)
    load(spark, tables, folder, opened, how)
    put(folder, "3", txn(5, 8, transaction_date=at(8, 23)), txn(6, 1), how=how)
    second = load(spark, tables, folder, opened, how)
    third = load(spark, tables, folder, opened, how)
    assert opened == [["1", "2"], ["2", "3"], ["2", "3"]]
    assert (second.read_rows, second.new_rows, second.left_out_rows) == (2, 1, 2)
    assert (third.read_rows, third.new_rows) == (2, 0)
    put(folder, "4", txn(7, 20), how=how)
    load(spark, tables, folder, opened, how)
    load(spark, tables, folder, opened, how)
    assert opened[3:] == [["2", "3", "4"], ["4"]]
    assert ids(spark, tables.landing) == ["TXN-1", "TXN-2", "TXN-3", "TXN-4", "TXN-5", "TXN-7"]


def test_nothing_to_open(spark, tables, tmp_path):
    """Unchanged files that end before the bound: only a changed lookback opens them again."""
    folder, opened = tmp_path / "in", []
    put(folder, "1", txn(1, 1))
    load(spark, tables, folder, opened)
    (folder / "1").unlink()
    put(folder, "2", txn(2, 9))
    load(spark, tables, folder, opened)
    (folder / "2").unlink()
    put(folder, "3", txn(3, 2))
    load(spark, tables, folder, opened)
    result = load(spark, tables, folder, opened)
    assert opened == [["1"], ["2"], ["3"], []]
    assert (result.read_rows, result.left_out_rows, result.new_rows, result.watermark) == (0, 0, 0, at(9))
    assert load(spark, tables, folder, opened, lookback_days=30).new_rows == 1 and opened[-1] == ["3"]
    assert load(spark, tables, folder, opened, lookback_days=30).new_rows == 0 and opened[-1] == ["3"]


def test_a_changed_file_is_opened_again(spark, tables, tmp_path):
    folder, opened = tmp_path / "in", []
    put(folder, "1", txn(1, 1))
    put(folder, "2", txn(2, 9))
    load(spark, tables, folder)
    put(folder, "1", txn(1, 1), txn(3, 9))
    assert load(spark, tables, folder, opened).new_rows == 1
    assert load(spark, tables, folder, opened).new_rows == 0
    assert opened == [["1", "2"], ["1", "2"]]
    put(folder, "1", txn(1, 1))  # of the old size, with another time
    load(spark, tables, folder, opened)
    load(spark, tables, folder, opened)
    assert opened[2:] == [["1", "2"], ["2"]]


def test_names_are_no_patterns(spark, tables, tmp_path):
    folder, opened = tmp_path / "in", []
    for n, name in enumerate(["a b.json", "a[1].json", "a{1,2}.json", "a%20b.json", "x?.json", "é.json"]):
        put(folder, name, txn(n, 1))
    load(spark, tables, folder)
    put(folder, "a1.json", txn(9, 1))
    load(spark, tables, folder)
    assert len(ids(spark, tables.landing)) == 7
    assert read_log(spark, tables.files, LEDGER_SCHEMA).count() == 7


@pytest.mark.parametrize("dies_at", ["landing", "ledger"])
def test_files_of_a_run_that_died_are_new(spark, tables, tmp_path, monkeypatch, dies_at):
    folder, opened = tmp_path / "in", []
    put(folder, "1", txn(1, 1), txn(2, 20))
    load(spark, tables, folder)
    put(folder, "2", txn(3, 20))

    def dying(*args):
        raise RuntimeError("lost the driver")

    if dies_at == "landing":
        monkeypatch.setattr(incremental, "add_batch", dying)
    else:
        monkeypatch.setattr(ledgers, "append_to_log", dying)
    with pytest.raises(RuntimeError):
        load(spark, tables, folder, batch_id="b")
    monkeypatch.undo()
    assert load(spark, tables, folder, opened, batch_id="b").new_rows == 1
    assert ids(spark, tables.landing) == ["TXN-1", "TXN-2", "TXN-3"]
    assert opened == [["1", "2"]]


def test_too_many_files_are_read_as_a_whole(spark, tables, tmp_path):
    folder, opened = tmp_path / "in", []
    for n in range(4):
        put(folder, str(n), txn(n, 1 + n))
    load(spark, tables, folder, opened, most_paths=2)
    put(folder, "4", txn(4, 4))
    load(spark, tables, folder, opened, most_paths=2)
    load(spark, tables, folder, opened, most_paths=9)
    assert opened == [list("0123"), list("01234"), list("234")]
    assert len(ids(spark, tables.landing)) == 5
    assert read_log(spark, tables.files, LEDGER_SCHEMA).count() == 5


def control_files(spark, tables):
    return len(batches.events(spark, tables).inputFiles())


def test_the_logs_are_folded(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "TAIL_EVENTS", 4)
    monkeypatch.setattr(ledgers, "TAIL_APPENDS", 4)
    folder = tmp_path / "in"
    for n in range(1, 7):
        put(folder, str(n), txn(n, n))
        load(spark, tables, folder, batch_id=f"b{n}", lookback_days=0)
        assert control_files(spark, tables) <= 6
        assert len(epochs(spark, tables.control)) <= 3 and len(epochs(spark, tables.files)) <= 3
    assert epochs(spark, tables.control)[-1] > 4
    assert read_log(spark, tables.files, LEDGER_SCHEMA).count() == 6
    assert len(read_log(spark, tables.files, LEDGER_SCHEMA).inputFiles()) <= 4
    rows = batches.events(spark, tables)
    assert [r[0] for r in rows.select("number").orderBy("number").collect()] == list(range(1, 13))
    first = load(spark, tables, folder, batch_id="b1")
    assert (first.new_rows, first.watermark) == (1, at(1))
    for _ in range(6):  # idle runs fold as well
        assert load(spark, tables, folder).new_rows == 0
        assert control_files(spark, tables) <= 7


def many_batches(spark, tables, n):
    """Two events of each of ``n`` batches, in some two hundred files."""
    number = F.col("id") + 1
    landed = F.col("id") % 2 == 1
    values = {
        "number": number,
        "batch_id": F.format_string("b%06d", F.floor(F.col("id") / 2)),
        "status": F.when(landed, batches.LANDED).otherwise(batches.OPEN),
        "owner": F.lit("job"),
        "read_rows": F.when(landed, F.lit(7)),
        "new_rows": F.when(landed, F.floor(F.col("id") / 2)),
        "last_successful_watermark": F.when(landed, F.lit(at(3))),
        "watermark": F.when(landed, F.lit(at(3))),
    }
    rows = spark.range(0, 2 * n, 1, 200).select(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CONTROL_SCHEMA), F.lit(0).cast("long").alias("epoch")
    )
    append_to_log(spark, tables.control, CONTROL_SCHEMA, rows.limit(0))
    rows.write.insertInto(tables.control)


def test_ten_thousand_batches(spark, tables, tmp_path):
    many_batches(spark, tables, 10_000)
    assert control_files(spark, tables) > 100
    folder = tmp_path / "in"
    put(folder, "1", txn(1, 3))
    assert load(spark, tables, folder, batch_id="new").new_rows == 1
    assert control_files(spark, tables) == 2  # the fold and what landed
    old = load(spark, tables, folder, batch_id="b000123")
    assert (old.read_rows, old.new_rows, old.watermark) == (7, 123, at(3))
    assert batches.events(spark, tables).count() == 20_002
    assert load(spark, tables, folder).new_rows == 0
    assert control_files(spark, tables) == 3


@pytest.mark.parametrize("dies", ["before", "after"])
def test_a_fold_that_died(spark, tables, tmp_path, monkeypatch, dies):
    """Before its rows are there, or after that and before former epochs are removed."""
    monkeypatch.setattr(batches, "TAIL_EVENTS", 5)
    folder = tmp_path / "in"
    for n in (1, 2):
        put(folder, str(n), txn(n, n))
        load(spark, tables, folder, batch_id=f"b{n}", owner="job")
    put(folder, "3", txn(3, 3))

    def dying(*args):
        if dies == "after":
            fold_log(*args)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(batches, "fold_log", dying)
    with pytest.raises(RuntimeError):
        load(spark, tables, folder, batch_id="b3", owner="job")
    monkeypatch.setattr(batches, "fold_log", fold_log)
    before = batches.read_control(spark, tables, "b2")
    assert (before.landed_batches, before.own.new_rows, before.open_batches) == (2, 1, (("b3", "job", "open"),))
    with pytest.raises(OpenBatchError):
        load(spark, tables, folder, batch_id="other")
    assert load(spark, tables, folder, batch_id="b4", owner="job").new_rows == 1
    assert ids(spark, tables.landing) == ["TXN-1", "TXN-2", "TXN-3"]
    assert len(epochs(spark, tables.control)) <= 2


def test_a_run_that_looked_before_a_fold_is_refused(spark, tables, tmp_path, monkeypatch):
    """Another run opens, folds and lands between this one's look and its opening."""
    monkeypatch.setattr(batches, "TAIL_EVENTS", 2)
    folder = tmp_path / "in"
    put(folder, "1", txn(1, 1))
    load(spark, tables, folder, batch_id="a")
    done = []

    def late(*args):
        if not done:
            done.append(True)
            load(spark, tables, folder, batch_id="faster")
        return open_batch(*args)

    put(folder, "2", txn(2, 1))
    open_batch = batches.open_batch
    monkeypatch.setattr(batches, "open_batch", late)
    with pytest.raises(OpenBatchError):
        load(spark, tables, folder, batch_id="slower")
    assert ids(spark, tables.landing) == ["TXN-1", "TXN-2"]
    assert load(spark, tables, folder, batch_id="slower").new_rows == 0


def test_epochs_only_grow(spark, tables):
    append_to_log(spark, tables.control, CONTROL_SCHEMA, spark.createDataFrame([], CONTROL_SCHEMA))
    many_batches(spark, tables, 2)
    kept = batches.events(spark, tables)
    fold_log(spark, tables.control, CONTROL_SCHEMA, kept, 4)
    with pytest.raises(ValueError):
        fold_log(spark, tables.control, CONTROL_SCHEMA, kept, 4)
