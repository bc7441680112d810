"""Catalog tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_exists(spark: SparkSession, name: str) -> bool:
    if name.count(".") != 1 or not all(name.split(".")):
        raise ValueError(f"table names are written schema.table, not {name!r}")
    return spark.catalog.tableExists(name)


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame of that schema before its first load."""
    if table_exists(spark, name):
        return spark.table(name)
    return spark.createDataFrame([], schema)
