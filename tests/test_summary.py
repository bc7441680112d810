from collections import defaultdict
from decimal import Decimal

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from txnmill.operators import quality, summary

BASE = (
    "account_id string, transaction_date date, amount decimal(18,2), transaction_type string, "
    "merchant_name string, merchant_category string, currency string"
)


def base_of(spark, *rows):
    day = __import__("datetime").date(2024, 1, 2)
    return spark.createDataFrame(
        [(a, day, None if m is None else Decimal(m), *rest) for a, m, *rest in rows], BASE
    )


def joined(base):
    top = summary.top_category(summary.ranked_categories(summary.category_spend(base)))
    return summary.daily_metrics(base).join(top, summary.ACCOUNT_DAY, "left").select(summary.SUMMARY_COLUMNS)


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_small_example(spark):
    base = base_of(
        spark,
        ("ACC-1001", "10.00", "debit", "A", "retail", "USD"),
        ("ACC-1001", "2.50", "credit", "A", "health", "EUR"),
        ("ACC-1001", "4.00", "debit", "B", "health", "USD"),
        ("ACC-1001", "3.50", "debit", "a", "health", "CHF"),
        ("ACC-1002", "5.00", "credit", "C", "payroll", "USD"),
    )
    rows = {r["account_id"]: r for r in summary.daily_summary(base).collect()}
    first = rows["ACC-1001"]
    assert first["total_debit_amount"] == Decimal("17.50")
    assert first["total_credit_amount"] == Decimal("2.50")
    assert first["net_amount"] == Decimal("-15.00")
    assert (first["transaction_count"], first["distinct_merchants"]) == (4, 3)
    # 10.00 against 10.00: the name decides.
    assert first["top_category"] == "health"
    assert first["currencies"] == "CHF,EUR,USD"
    # A day of credits only has a top category too.
    assert rows["ACC-1002"]["top_category"] == "payroll"
    assert as_rows(summary.daily_summary(base)) == as_rows(joined(base))


def test_nulls_agree_with_the_joined_form(spark):
    """Tables other than bronze may hold nulls; both forms treat them alike."""
    base = base_of(
        spark,
        ("A", "1.00", "debit", None, "x", None),
        ("A", None, "debit", "M", "y", "USD"),
        ("A", "1.00", "credit", "M", None, "EUR"),
        ("B", None, "debit", None, "z", None),
        ("B", None, "debit", None, "y", None),
    )
    assert as_rows(summary.daily_summary(base)) == as_rows(joined(base))


def test_both_forms_agree_on_all_records(spark):
    from checks.queries import QUERIES

    one = QUERIES["daily_account_summary"](spark, SMALL)
    two = QUERIES["daily_summary_join"](spark, SMALL)
    assert one.count() > 0
    assert as_rows(one) == as_rows(two)


def test_properties_of_the_summary(spark):
    from checks.queries import QUERIES

    days = QUERIES["daily_account_summary"](spark, SMALL)
    for check in (quality.null_fields, quality.repeated_days, quality.wrong_net, quality.empty_days):
        assert check(days).isEmpty()
    base = QUERIES["summary_base"](spark, SMALL)
    assert days.agg(F.sum("transaction_count")).first()[0] == base.count()


def test_against_plain_python(spark):
    from checks.queries import QUERIES

    groups = defaultdict(list)
    for row in QUERIES["summary_base"](spark, SMALL).collect():
        groups[(row["account_id"], row["transaction_date"])].append(row)
    expected = []
    for (account, day), rows in groups.items():
        debit = sum((r["amount"] for r in rows if r["transaction_type"] == "debit"), Decimal(0))
        credit = sum((r["amount"] for r in rows if r["transaction_type"] == "credit"), Decimal(0))
        spend = defaultdict(Decimal)
        for r in rows:
            spend[r["merchant_category"]] += r["amount"]
        expected.append(
            (
                account,
                day,
                debit,
                credit,
                credit - debit,
                len(rows),
                len({r["merchant_name"] for r in rows}),
                min(spend, key=lambda c: (-spend[c], c)),
                ",".join(sorted({r["currency"] for r in rows})),
            )
        )
    got = QUERIES["daily_account_summary"](spark, SMALL)
    assert as_rows(got) == sorted(expected, key=str)


@pytest.mark.parametrize(
    "check, fault",
    [
        (quality.null_fields, {"top_category": "cast(null as string)"}),
        (quality.wrong_net, {"net_amount": "net_amount + 1"}),
        (quality.empty_days, {"transaction_count": "0L"}),
    ],
)
def test_checks_find_planted_faults(spark, check, fault):
    base = base_of(
        spark,
        ("ACC-1001", "10.00", "debit", "A", "retail", "USD"),
        ("ACC-1002", "5.00", "credit", "C", "payroll", "USD"),
    )
    days = summary.daily_summary(base)
    broken = days.withColumns(
        {n: F.expr(f"if(account_id = 'ACC-1002', {c}, {n})") for n, c in fault.items()}
    )
    assert [row["account_id"] for row in check(broken).collect()] == ["ACC-1002"]


def test_repeated_days_are_found(spark):
    base = base_of(spark, ("ACC-1001", "10.00", "debit", "A", "retail", "USD"))
    days = summary.daily_summary(base)
    found = quality.repeated_days(days.unionByName(days)).collect()
    assert [(row["account_id"], row["n"]) for row in found] == [("ACC-1001", 2)]


def test_reconcile_shows_a_lost_row(spark):
    counts = spark.createDataFrame(
        [(10, 3, 7), (10, 3, 6)], "landing_rows long, quarantine_rows long, bronze_rows long"
    )
    assert [row["reconciled"] for row in quality.reconcile(counts).collect()] == [True, False]
