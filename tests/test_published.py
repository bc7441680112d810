"""What readers see while batches are written and folded, and the summary that follows the batches."""

import pytest
from pyspark.sql import functions as F
from test_loads import at, ids, load, txn
from txnmill.operators.summary import SUMMARY_COLUMNS, daily_summary, summary_base
from txnmill.plans import batches, compaction, incremental
from txnmill.plans import summary as summaries
from txnmill.plans.compaction import compact
from txnmill.plans.published import create_views, published, visible_batches
from txnmill.plans.summary import refresh_summary, touched_days


def seen(spark, tables, name="bronze"):
    """Ids by the function and by the view, which agree."""
    full = getattr(tables, name)
    by_function = sorted(r.transaction_id for r in published(spark, tables, full).collect())
    schema, table = full.split(".")
    spark.catalog.refreshTable(full)
    view = spark.table(f"{schema}.published_{table}")
    assert sorted(r.transaction_id for r in view.collect()) == by_function
    return by_function


def test_readers_see_whole_batches(spark, records, tables, monkeypatch):
    load(spark, tables, records(txn(1, 1), txn(2, 1, amount="x")), batch_id="a")
    create_views(spark, tables)
    between = []

    def reading(df, name, *more):
        add_batch(df, name, *more)
        if name in (tables.bronze, tables.landing):
            between.append((seen(spark, tables), seen(spark, tables, "landing"), seen(spark, tables, "quarantine")))

    add_batch = incremental.add_batch
    monkeypatch.setattr(incremental, "add_batch", reading)
    load(spark, tables, records(txn(3, 1), txn(4, 1, amount="x")), batch_id="b")
    assert between == [(["TXN-1"], ["TXN-1", "TXN-2"], ["TXN-2"])] * 2
    monkeypatch.undo()
    assert seen(spark, tables) == ["TXN-1", "TXN-3"] and seen(spark, tables, "quarantine") == ["TXN-2", "TXN-4"]


def test_readers_see_a_fold_as_a_whole(spark, records, tables, monkeypatch):
    for n in (1, 2):
        load(spark, tables, records(txn(n, 1)), batch_id=f"b{n}")
    create_views(spark, tables)
    between = []

    def reading(df, name, *more):
        add_batch(df, name, *more)
        if name == tables.bronze:
            between.append(seen(spark, tables))

    def before_dropping(spark, name, unwanted):
        if name == tables.bronze:
            between.append(seen(spark, tables))
        drop_batches(spark, name, unwanted)

    add_batch, drop_batches = compaction.add_batch, batches.drop_batches
    monkeypatch.setattr(compaction, "add_batch", reading)
    monkeypatch.setattr(batches, "drop_batches", before_dropping)
    fold = compact(spark, tables)
    assert between == [["TXN-1", "TXN-2"]] * 2
    load(spark, tables, records(txn(3, 1)), batch_id="b3")
    assert {r.batch_id for r in visible_batches(spark, tables).collect()} == {fold, "b3"}
    assert seen(spark, tables) == ["TXN-1", "TXN-2", "TXN-3"]


def rebuilt(spark, tables):
    return sorted(map(str, daily_summary(summary_base(spark.table(tables.bronze))).collect()))


def kept(spark, name):
    return sorted(map(str, spark.table(name).select(SUMMARY_COLUMNS).collect()))


def test_summary_by_batch_equals_the_rebuild(spark, records, tables, schema):
    name = f"{schema}.daily"
    assert refresh_summary(spark, tables, name) == 0
    load(spark, tables, records(txn(1, 1), txn(2, 2), txn(3, 2, account_id="ACC-1002"), txn(4, 3, amount="x")), batch_id="a")
    assert refresh_summary(spark, tables, name) == 2
    assert kept(spark, name) == rebuilt(spark, tables)
    first = {tuple(r)[:2]: r.updated_at for r in spark.table(name).select("account_id", "transaction_date", "updated_at").collect()}

    again = txn(5, 2, merchant_name="M2")  # a duplicate across runs
    more = records(again, txn(6, 2, currency="EUR", amount="99.5"), txn(7, 9, status="pending"), txn(8, 2, transaction_date=at(2, 5)))
    load(spark, tables, more, batch_id="b", lookback_days=5)
    assert refresh_summary(spark, tables, name) == 2
    assert kept(spark, name) == rebuilt(spark, tables)
    second = {tuple(r)[:2]: r.updated_at for r in spark.table(name).select("account_id", "transaction_date", "updated_at").collect()}
    assert [str(k[1]) + k[0] for k in sorted(first) if second[k] != first[k]] == ["2024-02-02ACC-1001"]
    assert refresh_summary(spark, tables, name) == 0

    # batches that were folded before they were summarised
    load(spark, tables, records(txn(10, 10)), batch_id="c")
    compact(spark, tables)
    load(spark, tables, records(txn(11, 11)), batch_id="d")
    assert refresh_summary(spark, tables, name) == 5
    assert kept(spark, name) == rebuilt(spark, tables)
    assert ids(spark, tables.bronze, "is_duplicate") == ["TXN-5"]


def test_a_refresh_that_died_is_done_again(spark, records, tables, schema, monkeypatch):
    name = f"{schema}.daily"
    load(spark, tables, records(txn(1, 1)), batch_id="a")

    def dying(*args):
        raise RuntimeError("lost the driver")

    for place in ("append_to_log", "replace_partitions"):
        monkeypatch.setattr(summaries, place, dying)
        with pytest.raises(RuntimeError):
            refresh_summary(spark, tables, name)
        monkeypatch.undo()
    assert refresh_summary(spark, tables, name) == 1
    assert kept(spark, name) == rebuilt(spark, tables)


def test_only_touched_days_are_read(spark, records, tables):
    load(spark, tables, records(*[txn(i, i) for i in range(1, 9)]), batch_id="a")
    load(spark, tables, records(txn(20, 8), txn(21, 8)), batch_id="b")
    bronze = published(spark, tables, tables.bronze)
    days = touched_days(bronze, ["b"])
    assert [str(day) for day in days] == ["2024-02-08"]
    again = summaries._touched_again(bronze, ["b"], days)
    for scan in again._jdf.queryExecution().executedPlan().toString().split("FileScan")[1:]:
        assert "2024-02-08" in scan or "event_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    files = bronze.filter(F.col("event_date").isin(days)).inputFiles()
    assert all("event_date=2024-02-08" in f for f in files) and len(files) == 2
    assert again.count() == 1
