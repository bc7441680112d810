"""What readers may see of batch tables: rows of batches that have landed, each batch as a whole.

Bronze, quarantine and landing of a batch are written before the control table says that it has landed, and a
fold has copied everything before the copied batches go. Two rules on the control table decide what counts:

* a fold counts once it is complete, and then no batch does that landed before it;
* any other batch counts once it has landed.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmill.plans import batches
from txnmill.plans.tables import Tables
from txnmill.sinks.log import EPOCH

PUBLISHED = "published_"


def visible_batches(spark: SparkSession, tables: Tables) -> DataFrame:
    """(batch_id, number) of the batches that count now."""
    return _visible(batches.events(spark, tables))


def _visible(events: DataFrame) -> DataFrame:
    complete = F.col("status") == batches.FOLDED
    last_fold = events.filter(complete).agg(F.coalesce(F.max("number"), F.lit(0))).scalar()
    since = (F.col("status") == batches.LANDED) & (F.col("number") > last_fold)
    return events.filter(since | complete).select("batch_id", "number")


def published(spark: SparkSession, tables: Tables, name: str) -> DataFrame:
    """Rows of the batch table ``name`` that count now.

    The list of batches is fixed before the table's files are looked up, so what it names is there, and what comes
    later is not seen. Other partitions are not read.
    """
    names = visible_batches(spark, tables).agg(F.collect_set("batch_id").alias("names")).first()["names"]
    spark.catalog.refreshTable(name)
    return spark.table(name).filter(F.col("batch_id").isin(names))


def create_views(spark: SparkSession, tables: Tables) -> list[str]:
    """Views ``published_...`` over the batch tables for readers that know SQL only; returns their names.

    A view looks the control table and the batch table up while its query is planned. A reader that must not miss
    a batch that lands in that moment uses :func:`published`.
    """
    made = []
    for name in (tables.landing, tables.quarantine, tables.bronze):
        schema, table = name.split(".")
        view = f"{schema}.{PUBLISHED}{table}"
        spark.sql(f"""
            CREATE OR REPLACE VIEW {view} AS
            WITH log AS (
              SELECT * FROM {tables.control} WHERE {EPOCH} = (SELECT max({EPOCH}) FROM {tables.control})
            )
            SELECT * FROM {name} WHERE batch_id IN (
              SELECT batch_id FROM log WHERE status = '{batches.FOLDED}' OR (status = '{batches.LANDED}'
                AND number > (SELECT coalesce(max(number), 0) FROM log WHERE status = '{batches.FOLDED}')))""")
        made.append(view)
    return made
