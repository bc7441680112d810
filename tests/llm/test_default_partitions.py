"""Queries in a session that leaves the number of shuffle partitions to Spark."""

import random

import __spark_entry__
import pytest

from txnmill.llm.common import shuffle_partitions
from txnmill.llm.packing import pack

# By finding of round 4, with columns left out: row numbers and slots may follow from how rows are dealt out.
QUERIES = {
    "pipeline": ["row_no"],  # F1
    "op1_top_k": [],  # F2
    "op4_token_files": [],  # F3
    "op5_span_fingerprints": [],  # F4
    "op9_simhash_groups": [],  # F6
    "op10_kd_shards": ["slot"],  # F7
    "op13_hard_negatives": [],  # F8
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    draw = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(draw.choices(words, k=draw.randrange(1, 60))) for _ in range(36)]
    texts += [texts[0], texts[1] + " vile", None, ""]
    docs = [(i, text, "en", f"s{i % 3}", len(text or "")) for i, text in enumerate(texts)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(30)]
    vectors = [(i, [draw.gauss(0, 1) for _ in range(4)], i % 3) for i in range(0, 300, 5)]
    for name, rows, schema in (
        ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", labels, "doc_id long, quality int, toxic int"),
        ("embeddings", vectors, "vec_id long, embedding array<float>, label int"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture
def left_to_spark(spark):
    """Take the setting away, and put it back after the test."""
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def unset():
        spark.conf.unset("spark.sql.shuffle.partitions")

    yield unset
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows_of(df, left_out=()):
    return sorted(df.drop(*left_out).collect(), key=repr)


def test_count_is_sparks_own(spark, left_to_spark):
    assert shuffle_partitions(spark) == 4
    left_to_spark()
    assert shuffle_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_with_a_count(spark, tables, left_to_spark, name):
    query = __spark_entry__.queries()[name]
    want = rows_of(query(spark, tables), QUERIES[name])
    left_to_spark()
    assert want and rows_of(query(spark, tables), QUERIES[name]) == want


def test_packing_in_several_parts(spark, tables, left_to_spark):
    """F5, op7_best_fit: the number is asked for where there is more than one part."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    want = rows_of(pack(docs, part_tokens=100), ["row_no"])
    left_to_spark()
    assert want and rows_of(pack(docs, part_tokens=100), ["row_no"]) == want
