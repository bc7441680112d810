"""The physical plans that make the queries scale."""

import io
import re
from contextlib import redirect_stdout

from conftest import SMALL
from pyspark.sql import functions as F
from test_loads import load, txn
from txnmill.operators import landing, repeats, routing, rules, summary
from txnmill.profiles import FULL


def plan_of(df, mode="simple"):
    """Initial plan, before adaptive execution simplifies it."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def stored_base(spark, schema):
    from checks.queries import QUERIES

    name = f"{schema}.bronze"
    QUERIES["mark_duplicates_full"](spark, SMALL).write.saveAsTable(name)
    return summary.summary_base(spark.table(name))


def scans_of(plan):
    return [
        set(re.findall(r"(\w+):", schema))
        for schema in re.findall(r"ReadSchema: struct<(.*)>", plan)
    ]


def test_summary_reads_only_the_columns_of_each_side(spark, schema):
    plan = plan_of(summary.daily_summary(stored_base(spark, schema)), "formatted")
    day = {"account_id", "transaction_ts", "status", "is_duplicate"}
    amounts, merchants = sorted(scans_of(plan), key=len, reverse=True)
    assert merchants == day | {"merchant_name"}
    assert amounts == day | {"amount", "transaction_type", "merchant_category", "currency"}
    assert plan.count("EqualTo(status,completed)") == 2
    assert plan.count("Not(EqualTo(is_duplicate,true))") == 2


def test_summary_shuffles_merchants_without_amounts(spark, schema):
    plan = plan_of(summary.daily_summary(stored_base(spark, schema)))
    by_merchant = [line for line in plan.splitlines() if "Exchange" in line and "merchant_name" in line]
    assert len(by_merchant) == 1
    # Every shuffle but those of a join lies between the two halves of an aggregate.
    steps = re.findall(r"(HashAggregate|ObjectHashAggregate|SortAggregate|Exchange hash|Scan)", plan)
    assert steps.count("Exchange hash") == 5 and "SortAggregate" not in steps
    # Next to each scan stands a hash aggregate.
    for i, step in enumerate(steps):
        if step == "Scan":
            assert steps[i - 1] == "HashAggregate"


def test_top_category_limits_groups_before_the_shuffle(spark, schema):
    ranked = summary.ranked_categories(summary.category_spend(stored_base(spark, schema)))
    assert "WindowGroupLimit" in plan_of(summary.top_category(ranked))


def test_rules_stay_in_one_generated_stage(spark, records):
    frame = landing.land(records({}), FULL)
    for routed in (routing.valid, routing.quarantined):
        plan = plan_of(routed(rules.validate(frame, FULL)))
        assert "Python" not in plan and "Exchange" not in plan
        assert "lambda" not in plan  # the message array is pruned away
        assert all("*(" in line for line in plan.splitlines() if re.search(r"(Project|Filter) ", line))


def test_one_rule_reads_its_own_columns(spark, schema, records):
    landing.land(records({}), FULL).write.saveAsTable(f"{schema}.landed")
    checked = rules.with_rule_messages(spark.table(f"{schema}.landed"), FULL)
    assert scans_of(plan_of(checked.select("err_amount"), "formatted")) == [{"amount_raw"}]
    assert scans_of(plan_of(checked.filter("err_status is not null").select("err_amount"), "formatted")) == [
        {"amount_raw", "status"}
    ]


def test_without_heavy_keys_the_plan_is_one_shuffle(spark, records):
    rows = routing.valid(rules.validate(landing.land(records(*[{}] * 30), FULL), FULL))
    for known in ({"row_count": 1}, {}):
        plan = plan_of(repeats.mark_duplicates(rows, **known))
        assert plan.count("Exchange") == 1 and plan.count("Scan") == 1
    searched = plan_of(repeats.mark_duplicates(rows, heavy_rows=20))
    assert "LeftAnti" in searched and "LeftSemi" in searched
    assert not re.search(r"hashpartitioning\(key_hash#\d+L, \d+\)", searched)  # never by the hash alone


def test_join_with_stored_keys_and_ranking_share_one_shuffle(spark, records):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = routing.valid(rules.validate(landing.land(records({}), FULL), FULL))
        plan = plan_of(repeats.mark_duplicates(rows, rows, row_count=1))
        assert plan.count("Exchange") == 2  # the rows once, the stored keys once
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_laid_out_by_day_are_shuffled_once(spark, records):
    from txnmill.plans.full_load import with_day_slots

    rows = routing.valid(rules.validate(landing.land(records({}), FULL), FULL))
    slotted, _ = with_day_slots(rows)
    marked = repeats.mark_duplicates(
        slotted, row_count=1, cluster_by=["event_date", "slot"], partitions=4
    )
    plan = plan_of(marked)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # One for the rows; the other is the count per day on the broadcast side.
    assert len(shuffles) == 2 and sum("slot" in line for line in shuffles) == 1


def test_stored_days_are_pruned(spark, records, tables):
    load(spark, tables, records(txn(1, 1), txn(2, 5)), batch_id="a")
    stored = spark.table(tables.bronze).filter(F.col("batch_id") != "b")
    near = stored.filter("event_date between date'2024-02-04' and date'2024-02-06'")
    plan = plan_of(near, "formatted")
    assert re.search(r"PartitionFilters: \[.*event_date.*2024-02-04", plan)
