"""Names of the tables a load writes, and the staged frames between its steps."""

import uuid
import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from txnmill.session import shared_dir


@dataclass(frozen=True)
class Tables:
    landing: str
    quarantine: str
    bronze: str
    control: str
    files: str  # ledger of source files
    ids: str  # landed ids, and
    keys: str  # hashes of stored natural keys: what a batch is compared with, see plans/history.py

    @classmethod
    def in_schema(cls, schema: str, suffix: str = "") -> "Tables":
        """Full and incremental loads lay their tables out differently, so a schema that
        takes both needs a suffix for one of them."""
        return cls(
            landing=f"{schema}.landing_transactions{suffix}",
            quarantine=f"{schema}.quarantine_transactions{suffix}",
            bronze=f"{schema}.bronze_transactions{suffix}",
            control=f"{schema}.load_batches{suffix}",
            files=f"{schema}.source_files{suffix}",
            ids=f"{schema}.landed_ids{suffix}",
            keys=f"{schema}.stored_key_hashes{suffix}",
        )

    def batch_tables(self) -> dict[str, list[str]]:
        """Tables that hold rows of batches, with their partition columns after the batch."""
        return {
            self.landing: [],
            self.quarantine: [],
            self.bronze: ["event_date"],
            self.ids: [],
            self.keys: [],
        }


class Staging:
    """A folder of one run in the shared folder."""

    def __init__(self, spark: SparkSession, tables: Tables, batch: str):
        name = f"{batch}-{uuid.uuid4().hex[:12]}"
        self.path = f"{shared_dir(spark)}/txnmill-staged/{tables.landing}/{name}"

    def write(self, df: DataFrame, step: str, partition_by: Sequence[str] = ("is_valid",)) -> DataFrame:
        """Write a frame and go on from the files.

        Cuts the lineage durably: later steps neither read the source again nor see tables
        change under them, and lost executors cost a re-read, not a re-run. The split by
        validity makes both routes partition reads.
        """
        path = f"{self.path}/{step}"
        df.write.partitionBy(*partition_by).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession, tables: Tables, batch: str) -> Iterator[Staging]:
    """A folder that goes when the run ends, well or not. A driver that dies leaves it behind;
    no other run ever reads it. So a folder that cannot be removed costs room and a warning, not
    the run, which may have landed, nor the error that ended it."""
    folder = Staging(spark, tables, batch)
    try:
        yield folder
    finally:
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder.path)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception as failed:
            warnings.warn(f"{folder.path} is left behind: {failed}", stacklevel=3)
