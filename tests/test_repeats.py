"""Duplicate flags against a brute-force count, on all physical paths."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from txnmill.operators import increment, landing, repeats, routing, rules, skew
from txnmill.profiles import FULL
from txnmill.schema import NATURAL_KEY


def brute_force(rows, stored=()):
    """(key, id) of every row with its flag; rows tied in key and id are interchangeable."""
    known = {tuple(row[name] for name in NATURAL_KEY) for row in stored}
    seen, out = set(), Counter()
    for row in sorted(rows, key=lambda r: r["transaction_id"]):
        key = tuple(row[name] for name in NATURAL_KEY)
        out[(key, row["transaction_id"], key in seen or key in known)] += 1
        seen.add(key)
    return out


def flags(frame):
    return Counter(
        (tuple(row[name] for name in NATURAL_KEY), row["transaction_id"], row["is_duplicate"])
        for row in frame.collect()
    )


@pytest.fixture(scope="module")
def rows(spark):
    """Skewed: a third of all rows are copies of one transaction, half of these with one id."""
    from conftest import GOOD
    from txnmill.schema import RECORD_FIELDS, RECORD_SCHEMA

    rng = random.Random(5)
    made = []
    for i in range(600):
        record = dict(GOOD, transaction_id=f"TXN-{rng.randrange(10_000)}")
        if i % 3:
            record.update(account_id=f"ACC-10{rng.randrange(1, 21):02}", amount=str(rng.randrange(1, 9)))
        elif i % 2:
            record["transaction_id"] = "TXN-0"
        made.append(tuple(record[name] for name in RECORD_FIELDS))
    frame = spark.createDataFrame(made, RECORD_SCHEMA).repartition(7)
    return routing.valid(rules.validate(landing.land(frame, FULL), FULL)).cache()


@pytest.mark.parametrize("heavy_rows", [2, 20, 150, 10**6])
@pytest.mark.parametrize("with_stored", [False, True])
def test_flags_match_brute_force(rows, heavy_rows, with_stored):
    stored = rows.filter("amount in (3, 10.5)") if with_stored else None
    marked = repeats.mark_duplicates(rows, stored, heavy_rows=heavy_rows)
    assert flags(marked) == brute_force(rows.collect(), stored.collect() if with_stored else ())
    assert marked.columns == [*rows.columns, "is_duplicate"]


def test_known_row_count_gives_the_same_flags(rows):
    n = rows.count()
    assert flags(repeats.mark_duplicates(rows, row_count=n)) == brute_force(rows.collect())


@pytest.mark.parametrize("heavy_rows", [20, 10**6])
def test_shuffle_by_day_and_slot_gives_the_same_flags(rows, heavy_rows):
    from txnmill.plans.full_load import with_day_slots

    slotted, slots = with_day_slots(rows, rows_per_file=100)
    assert slots == -(-rows.count() // 100)
    marked = repeats.mark_duplicates(
        slotted, heavy_rows=heavy_rows, cluster_by=["event_date", "slot"], partitions=4
    )
    assert flags(marked) == brute_force(rows.collect())


def test_heavy_keys_are_found(rows):
    hashed = skew.with_key_hash(rows, NATURAL_KEY)
    assert len(skew.heavy_key_hashes(hashed, 150)) == 1
    assert skew.heavy_key_hashes(hashed, 10**6) == []
    assert skew.heavy_key_hashes(hashed.limit(0), 1) == []


def test_sketch_finds_every_key_of_the_stated_share(spark):
    """A third of the rows, a thousandth and nearly unique ones, many times as many as a sketch tracks."""
    n = 600_000
    share = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 1001 == 1, -2).otherwise(F.col("id"))
    keys = spark.range(0, n, 1, 40).select(share.alias("key"))
    found = skew.heavy_key_hashes(skew.with_key_hash(keys, ["key"]).select("key_hash"), n // 2340)
    by_hand = skew.with_key_hash(spark.createDataFrame([(-1,), (-2,)], "key long"), ["key"])
    assert found[0] == by_hand.first()["key_hash"]
    assert set(found) == {r["key_hash"] for r in by_hand.collect()}


def test_sketches_alone_are_shuffled(spark):
    keys = skew.with_key_hash(spark.range(0, 100_000, 1, 10), ["id"]).select("key_hash")
    merged = skew.key_sketch(keys)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "hashpartitioning(key_hash" not in plan
    before_shuffle = plan[plan.rindex("Exchange") :]
    assert "partial_approx_top_k_accumulate" in before_shuffle
    assert len(bytes(merged.first()["sketch"]["sketch"])) < 400_000


def test_separator_in_a_name_does_not_merge_keys(spark, records):
    frame = records(
        {"transaction_id": "TXN-1", "merchant_name": "a||retail", "merchant_category": "retail"},
        {"transaction_id": "TXN-2", "merchant_name": "a", "merchant_category": "retail"},
    )
    valid = routing.valid(rules.validate(landing.land(frame, FULL), FULL))
    assert repeats.mark_duplicates(valid).filter("is_duplicate").isEmpty()
    text = repeats.natural_key_text(valid).filter("transaction_id = 'TXN-2'").first()["natural_key"]
    assert text == "ACC-1001||2024-02-01T10:00:00Z||10.50||USD||debit||a||retail||completed||US"


def test_ids_are_ordered_as_text(records):
    frame = records({"transaction_id": "TXN-9"}, {"transaction_id": "TXN-10"})
    valid = routing.valid(rules.validate(landing.land(frame, FULL), FULL))
    marked = {r["transaction_id"]: r["is_duplicate"] for r in repeats.mark_duplicates(valid).collect()}
    assert marked == {"TXN-10": False, "TXN-9": True}


@pytest.mark.parametrize("heavy_rows", [5, 150, 10**6])
def test_new_rows_match_brute_force(spark, heavy_rows):
    values = ["", None, "a", "b", "c"] * 40 + [f"x{i}" for i in range(100)]
    frame = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "transaction_id string, n int")
    known = {"", "b", "x1", "x2", "other"}
    ids = spark.createDataFrame([(v,) for v in known], "transaction_id string")
    new = increment.new_rows(frame.repartition(5), ids, heavy_rows=heavy_rows)
    expected = sorted(i for i, v in enumerate(values) if v is None or v not in known)
    assert sorted(row["n"] for row in new.collect()) == expected


@pytest.mark.parametrize("heavy_rows", [20, 10**6])
def test_seen_before_matches_brute_force(rows, heavy_rows):
    keys = repeats.known_keys(rows.filter("amount in (3, 10.5)"))
    known = {tuple(row) for row in keys.collect()}
    seen = repeats.with_seen_before(rows, keys, heavy_rows=heavy_rows).collect()
    assert len(seen) == rows.count()
    for row in seen:
        assert row["existing_duplicate"] == (tuple(row[name] for name in NATURAL_KEY) in known)


def test_seen_before_never_multiplies_rows(rows):
    keys = repeats.known_keys(rows)
    seen = repeats.with_seen_before(rows, keys)
    assert seen.count() == rows.count()
    assert seen.filter(~F.col("existing_duplicate")).isEmpty()
