"""Session settings and the shared folder for written intermediates."""

import tempfile
from functools import lru_cache

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates carry a literal Z, so every parse, range test and date cast runs in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's partition count, Spark's default where none is set; some platforms leave it to ``auto``."""
    wanted = spark.conf.get("spark.sql.shuffle.partitions")
    return int(wanted) if wanted.isdigit() else 2 * spark.sparkContext.defaultParallelism


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged batches, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"txnmill-{application}-")
