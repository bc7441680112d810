"""What several corpus operators share: staging, hashing of whole rows, worker set-up."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmill.session import shared_dir

# Words of the corpus operators: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_written: list[list[str]] = []  # folders of the open ``removed_after`` blocks


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and go on from the files.

    This cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    if _written:
        _written[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def removed_after(spark: SparkSession) -> Iterator[None]:
    """Remove what ``staged`` writes inside the block when the block ends, well or not. What reads it has to be
    written inside as well. A driver that dies leaves its folders behind; no other run reads them."""
    folders: list[str] = []
    _written.append(folders)
    try:
        yield
    finally:
        _written.pop()
        for folder in folders:
            remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def workers_see_package(spark: SparkSession) -> None:
    """Let Python workers started from this folder import the package; on a cluster ``--py-files`` does."""
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}" if known else root


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's partition count, or what the cluster can run twice over if it is not a number.

    Spark has a default of its own; one given here would have to be a number, or it fails where none is set."""
    wanted = spark.conf.get("spark.sql.shuffle.partitions")
    return int(wanted) if wanted.isdigit() else 2 * spark.sparkContext.defaultParallelism


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
