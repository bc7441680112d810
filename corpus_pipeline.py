"""Corpus pipeline: toxicity, near-duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All but the last keep the columns of documents. What a stage
writes on its way goes when its result is written, and its documents go when the next stage has read them.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from txnmill.llm.common import remove, removed_after, table
from txnmill.llm.mixing import mixed_documents
from txnmill.llm.packing import pack
from txnmill.llm.simhash import one_of_each_group
from txnmill.llm.toxicity import train, without_rejected
from txnmill.session import shared_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled ones does not reject."""
    return without_rejected(docs, train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link at two bits."""
    return one_of_each_group(docs, shingle_words=3, radius=2)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at 1, 2, 3 parts in turn, none more than three times."""
    return mixed_documents(docs, weights=(1, 2, 3), cap=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bin and place of every piece; ``row_no`` numbers the documents of the mix."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]
ORACLE_SQL = None  # fingerprints, fitted weights, seeded selection and packing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/llm-pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        path = f"{base}/{name}"
        with removed_after(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
