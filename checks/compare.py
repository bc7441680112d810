"""Run registered queries next to their SQL and compare all rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import oracle_sql
from checks.queries import QUERIES


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def rows_of(df: DataFrame) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(row) for row in df.select(names).collect())


def oracle_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    relation = connection.sql(sql)
    names = sorted(relation.columns)
    listed = ", ".join(f'"{name}"' for name in names)
    return names, Counter(connection.sql(f"SELECT {listed} FROM ({sql}) AS q").fetchall())


def main() -> int:
    sf_dir, chosen = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failed = duckdb_tables(sf_dir), oracle_sql(), 0
    for name in chosen:
        started = time.time()
        df = QUERIES[name](spark, sf_dir)
        got, names = rows_of(df), sorted(df.columns)
        seconds = time.time() - started
        if name not in oracles:
            print(f"----  {name:30} {sum(got.values()):7} rows, no SQL  {seconds:.1f}s", flush=True)
            continue
        expected_names, expected = oracle_rows(connection, oracles[name])
        good = names == expected_names and got == expected
        failed += not good
        print(f"{'ok' if good else 'FAIL':5} {name:30} {sum(got.values()):7} rows  {seconds:.1f}s", flush=True)
        if not good:
            print("   columns", names, expected_names)
            print("   only here ", list((got - expected).items())[:3])
            print("   only there", list((expected - got).items())[:3])
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
