"""The jobs of the command line, one after the other on the same files."""

import sys

from test_loads import at, txn
from txnmill import __main__ as jobs
from txnmill.sinks.tables import export_csv


def run(monkeypatch, *args):
    monkeypatch.setattr(sys, "argv", ["txnmill", *map(str, args)])
    jobs.main()


def test_jobs(spark, records, schema, tmp_path, monkeypatch, capsys):
    rows = [txn(1, 1), txn(2, 2), txn(3, 2, amount="x"), txn(4, 2, merchant_name="M2")]
    export_csv(records(*rows).coalesce(1), str(tmp_path / "csv"))
    summary = f"{schema}.daily"

    run(monkeypatch, "full", "--schema", schema, "--csv", tmp_path / "csv", "--pages", tmp_path / "none")
    run(monkeypatch, "summary", "--bronze", f"{schema}.bronze_transactions", "--summary", summary)
    out = capsys.readouterr().out
    assert "TXN-3" in out and "TXN-4" in out and "FOUND" not in out
    assert spark.table(summary).count() == 2

    for _ in range(2):
        run(monkeypatch, "incremental", "--schema", schema, "--csv", tmp_path / "csv")
    out = capsys.readouterr().out
    assert "new_rows=4" in out and "new_rows=0" in out and at(2) in out

    third = f"{schema}_stream"
    spark.sql(f"CREATE DATABASE {third}")
    run(monkeypatch, "stream", "--schema", third, "--csv", tmp_path / "csv", "--checkpoint", tmp_path / "cp")
    assert spark.table(f"{third}.bronze_transactions_incremental").count() == 3
