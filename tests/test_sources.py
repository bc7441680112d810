import json

import pytest
from conftest import GOOD
from txnmill.operators import landing
from txnmill.profiles import FULL, INCREMENTAL
from txnmill.schema import LANDING_FIELDS, RECORD_FIELDS
from txnmill.sources.records import CSV_LABEL, PAGES_LABEL, read_csv, read_json_pages, read_source, since
from txnmill.sources.tables import table_exists, table_or_empty

HEADER = ",".join(RECORD_FIELDS)


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding, newline="")
    return str(path)


def test_csv_with_bom_quotes_breaks_blanks_and_short_rows(spark, tmp_path):
    text = (
        f"{HEADER}\r\n"
        'TXN-1,ACC-1001,2024-02-01T10:00:00Z,1.0,USD,debit,"Say ""hi"", you",retail,completed,US\r\n'
        'TXN-2,ACC-1001,2024-02-01T10:00:00Z,,USD,debit,"two\nlines",retail,completed,US\r\n'
        "\r\n"
        " TXN-3,ACC-1001,2024-02-01T10:00:00Z,007.50,USD,debit,   ,retail,completed\r\n"
    )
    rows = read_csv(spark, write(tmp_path / "a.csv", text, "utf-8-sig")).collect()
    assert [r["transaction_id"] for r in rows] == ["TXN-1", "TXN-2", " TXN-3"]
    assert [r["merchant_name"] for r in rows] == ['Say "hi", you', "two\nlines", "   "]
    assert [r["amount"] for r in rows] == ["1.0", None, "007.50"]
    assert [r["country_code"] for r in rows] == ["US", "US", None]


def test_csv_fields_are_found_by_name(spark, tmp_path):
    text = "extra,amount,Status,transaction_id\nx,5.00,completed,TXN-1\n"
    frame = read_csv(spark, write(tmp_path / "a.csv", text))
    assert frame.columns == RECORD_FIELDS
    row = frame.first()
    assert (row["transaction_id"], row["amount"]) == ("TXN-1", "5.00")
    # Header names are matched exactly.
    assert row["status"] is None and row["account_id"] is None


def test_files_with_different_headers_fail_loudly(spark, tmp_path):
    write(tmp_path / "a.csv", "amount,status\n1.00,completed\n")
    write(tmp_path / "b.csv", "status,amount\ncompleted,1.00\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_numbers_of_pages_keep_their_text(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    page = json.dumps([{**GOOD, "amount": 67.4}, {"transaction_id": "TXN-2", "other": 1}])
    write(pages / "1.json", page.replace("67.4", "67.40"))
    write(pages / "2.json", "\n [ {\"amount\": -127.5},\n {\"amount\": 0.0} ]")
    write(pages / "3.json", "[]")
    large = ["10000000.00", "12345678.90", "1234567890123456.78", "1.10"]
    write(pages / "4.json", "[" + ", ".join('{"amount": %s}' % n for n in large) + "]")
    rows = read_json_pages(spark, str(pages)).collect()
    assert sorted(str(r["amount"]) for r in rows) == sorted(["-127.5", "0.0", "67.40", "None", *large])
    write(tmp_path / "lines.json", "\n".join('{"amount": %s}' % n for n in large))
    lines = read_json_pages(spark, str(tmp_path / "lines.json"), json_lines=True).collect()
    assert sorted(r["amount"] for r in lines) == sorted(large)


def test_files_of_lines_are_split(spark, records, tmp_path):
    frame = records(*({"transaction_id": f"TXN-{i}", "merchant_name": "M" * 200} for i in range(300)))
    frame.coalesce(1).write.csv(str(tmp_path / "csv"), header=True)
    frame.coalesce(1).write.json(str(tmp_path / "lines"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        csv = read_source(spark, None, str(tmp_path / "csv"), multi_line=False).records
        lines = read_source(spark, str(tmp_path / "lines"), "", json_lines=True).records
        for split in (csv, lines):
            assert split.rdd.getNumPartitions() > 3 and split.count() == 300
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


NO_PAGES = [
    '{"message": "no"}', "oops", '[{"amount": 1', "  ", "5", "null", '[{"amount": 1} {"amount": 2}]', '[{"amount": 1}] more',
    '[{"amount": 1}]\n[{"amount": 2}]', '[{"amount": 1}],[{"amount": 2}]', "[1, 2]", '["a"]', '[[{"amount": 1}]]', '[{"amount": 1}, null]',
    '[{"amount": 01}]', '[{"amount": 1.2.3}]', '[{"amount": -}]', '[{"amount": 1.}]', '[{"amount": tru}]', '[{"amount": 5 6}]',
]


@pytest.mark.parametrize("text", NO_PAGES)
def test_a_page_that_is_no_array_of_records_fails(spark, tmp_path, text):
    write(tmp_path / "1.json", text)
    for read in (lambda rows: rows.collect(), lambda rows: rows.select("status").collect()):
        with pytest.raises(Exception, match="not a JSON array|MALFORMED"):
            read(read_json_pages(spark, str(tmp_path)))


def test_text_in_pages_is_left_alone(spark, tmp_path):
    """Names that look like fields, brackets and quotes inside of strings, nested and unknown fields."""
    records = [
        {"merchant_name": '"amount": 5, x', "amount": "1.50", "currency": "}],{["},
        {"merchant_name": 'ends with \\"amount', "status": '\\', "x": {"amount": [1, {"amount": 2}]}},
        {"account_id": "amount", "amount": None, "status": True, "transaction_id": "a: 7,"},
    ]
    page = json.dumps(records)[:-1] + ', {"status" : \n-0.0 , "country_code":1E+5}, {"amount":12345678901234567890.10, "amount_x": 1.50}]'
    write(tmp_path / "1.json", page)
    got = [{k: v for k, v in r.asDict().items() if v is not None} for r in read_json_pages(spark, str(tmp_path)).collect()]
    assert got == [
        records[0],
        {"merchant_name": 'ends with \\"amount', "status": '\\'},
        {"account_id": "amount", "status": "true", "transaction_id": "a: 7,"},
        {"status": "-0.0", "country_code": "1E+5"},
        {"amount": "12345678901234567890.10"},
    ]


def test_pages_are_read_once_and_not_by_position(spark, tmp_path):
    write(tmp_path / "1.json", json.dumps([GOOD] * 3))
    plan = read_json_pages(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "FileScan text" in plan and "Python" not in plan


def test_json_lines(spark, tmp_path):
    write(tmp_path / "1.json", json.dumps(GOOD) + "\n" + json.dumps({**GOOD, "amount": 1.50}) + "\n")
    rows = read_json_pages(spark, str(tmp_path), json_lines=True).collect()
    assert [r["amount"] for r in rows] == ["10.50", "1.5"]


def test_since_is_inclusive_and_drops_unreadable_dates(records):
    dates = [
        "2024-01-05T00:00:00Z",
        "2024-01-04T23:59:59Z",
        "2024-1-5T0:0:0Z",  # read here, refused by the format rule later
        " 2024-01-06T00:00:00Z",
        "2024-01-32T00:00:00Z",
        "2024-01-06 00:00:00",
        "2024-01-07t00:00:00z",
        None,
    ]
    frame = records(*[{"transaction_date": date} for date in dates])
    kept = {r["transaction_date"] for r in since(frame, "2024-01-05T00:00:00Z").collect()}
    assert kept == {"2024-01-05T00:00:00Z", "2024-1-5T0:0:0Z", "2024-01-07t00:00:00z"}
    assert since(frame, None).count() == len(dates)


def test_source_is_labelled_by_what_was_read(spark, tmp_path):
    csv = write(tmp_path / "a.csv", f"{HEADER}\n{','.join(GOOD.values())}\n")
    pages = tmp_path / "pages"
    missing = read_source(spark, str(pages), csv)
    assert (missing.label, missing.records.count()) == (CSV_LABEL, 1)
    pages.mkdir()
    write(pages / "1.json", json.dumps([GOOD, GOOD]))
    found = read_source(spark, str(pages), csv)
    assert (found.label, found.records.count()) == (PAGES_LABEL, 2)
    assert read_source(spark, None, csv, bound="2024-03-01T00:00:00Z").records.isEmpty()


def test_landing_profiles(records):
    frame = records(
        {"transaction_id": " txn-1\t", "merchant_name": " Shop ", "currency": " USD\n", "status": None}
    )
    full = landing.land(frame, FULL).first()
    assert (full["transaction_id"], full["currency"]) == (" txn-1\t", " USD\n")
    clean = landing.land(frame, INCREMENTAL).first()
    assert (clean["transaction_id"], clean["currency"]) == ("TXN-1", "USD")
    assert (clean["merchant_name"], clean["status"]) == (" Shop ", None)
    assert landing.land(frame, FULL).columns == LANDING_FIELDS


def test_tables_by_name(spark, schema):
    assert not table_exists(spark, f"{schema}.nothing")
    empty = table_or_empty(spark, f"{schema}.nothing", spark.range(1).schema)
    assert empty.columns == ["id"] and empty.isEmpty()
    spark.range(3).write.saveAsTable(f"{schema}.something")
    assert table_exists(spark, f"{schema}.something")
    assert table_or_empty(spark, f"{schema}.something", empty.schema).count() == 3
    for name in ("something", "a.b.c", ".x"):
        with pytest.raises(ValueError):
            table_exists(spark, name)
