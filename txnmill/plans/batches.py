"""What is known about batches: who opened them, what they stored, how far they read.

The control table only grows: a run appends a row when it opens a batch, before it stores
anything, and one when the batch has landed. That last row is the commit: it holds the result
and the watermark, so neither can be saved without the other. A batch that was opened and has
no later row belongs to a run that is still at work or died.

* A batch that landed is never touched again. Running its id once more returns its result.
* A run clears what a dead run of its own left: one of the same batch id or the same owner.
* An open batch of anyone else is left alone and the run is refused.
* Between a run's first look and its opening no other run may have added a row; otherwise
  what it read of the tables is out of date and it is refused too.

Rows are ordered by a number, not by clocks. It is one more than the largest number a run saw.

The table is a log (``sinks/log.py``). A run that has opened its batch has it for itself and folds it if more
than ``TAIL_EVENTS`` rows came since the last fold. Folds keep all rows, and the number of the last one
names the epoch. A run that looked before a fold and writes after it finds another epoch and is refused.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmill.functions.times import utc_now
from txnmill.plans.tables import Tables
from txnmill.schema import CONTROL_SCHEMA, WATERMARK_SCHEMA
from txnmill.sinks.log import append_to_log, fold_log, latest_epoch, read_log
from txnmill.sinks.tables import clear_batch, drop_batches

OPEN, LANDED, DROPPED, IDLE = "open", "landed", "dropped", "idle"
# A fold (plans/compaction.py) is complete, and then rid of what it copied.
FOLDED, CLOSED = "folded", "closed"
FOLD = "fold-"

# Rows of the control table that lie in files of their own before they are folded into one file.
TAIL_EVENTS = 64


class OpenBatchError(RuntimeError):
    """Another run is at work on the tables, or died there."""


@dataclass(frozen=True)
class BatchResult:
    batch_id: str
    read_rows: int
    new_rows: int
    watermark: str | None  # latest event time among the new bronze rows and the saved one
    left_out_rows: int | None = None  # read but dated before the bound or unreadably; None: not counted


@dataclass(frozen=True)
class Control:
    """What a run needs to know of the control table; a few rows, however long the history."""

    epoch: int
    rows: int
    last_number: int
    open_batches: tuple[tuple[str, str, str], ...]  # (batch_id, owner, status)
    landed_batches: int
    own: BatchResult | None  # result of the run's own id if it has landed


def events(spark: SparkSession, tables: Tables) -> DataFrame:
    return read_log(spark, tables.control, CONTROL_SCHEMA)


def read_control(spark: SparkSession, tables: Tables, batch_id: str) -> Control:
    """One aggregation of the control table; open batches are looked up only if there are any of others."""
    epoch = latest_epoch(spark, tables.control)
    known = events(spark, tables)
    status = F.col("status")
    own = F.struct("read_rows", "new_rows", "watermark", "left_out_rows")
    mine = F.col("batch_id") == batch_id
    row = known.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.max("number"), F.lit(0)).alias("last"),
        F.count_if(status == OPEN).alias("opened"),
        F.count_if(status.isin(LANDED, DROPPED, CLOSED)).alias("closed"),
        F.count_if(status == LANDED).alias("landed"),
        F.max_by(own, F.when(mine & (status == LANDED), F.col("number"))).alias("own"),
        F.max_by(F.struct("batch_id", "owner", "status"), F.when(mine & (status != IDLE), F.col("number"))).alias("mine"),
    ).first()
    result = BatchResult(batch_id, **row["own"].asDict()) if row["own"] else None
    open_batches = ()
    if row["opened"] - row["closed"] == 1 and row["mine"] and row["mine"]["status"] == OPEN:
        open_batches = (tuple(row["mine"]),)
    elif row["opened"] > row["closed"]:
        open_batches = _open(known)
    return Control(epoch, row["rows"], row["last"], open_batches, row["landed"], result)


def _open(known: DataFrame) -> tuple[tuple[str, str, str], ...]:
    last = known.filter(F.col("status") != IDLE).groupBy("batch_id").agg(
        F.max_by("status", "number").alias("status"), F.max_by("owner", "number").alias("owner")
    )
    still = last.filter(F.col("status").isin(OPEN, FOLDED)).select("batch_id", "owner", "status")
    return tuple(tuple(row) for row in still.collect())


def add_event(
    spark: SparkSession, tables: Tables, number: int, batch_id: str, status: str, owner: str, **more
) -> None:
    values = {
        "number": number, "batch_id": batch_id, "status": status, "owner": owner,
        "last_run_timestamp": utc_now(), **more,
    }
    # literals, because a row that comes from Python takes four times as long to write
    row = spark.sql("SELECT 1").select(
        *(F.lit(values.get(field.name)).cast(field.dataType).alias(field.name) for field in CONTROL_SCHEMA)
    )
    append_to_log(spark, tables.control, CONTROL_SCHEMA, row)


def clear_own_leftovers(
    spark: SparkSession, tables: Tables, control: Control, batch_id: str, owner: str
) -> Control:
    """Remove what dead runs of this id or owner stored; refuse to run beside anyone else's."""
    foreign = [b for b, o, _ in control.open_batches if b != batch_id and o != owner]
    if foreign:
        raise OpenBatchError(
            f"batch {foreign[0]!r} of another run is open; if that run died, run it again under "
            "its batch id or owner"
        )
    number = control.last_number
    for batch, its_owner, status in control.open_batches:
        if status == FOLDED:
            number = finish_fold(spark, tables, number, batch, its_owner)
            continue
        for name, partition_by in tables.batch_tables().items():
            clear_batch(spark, name, batch, partition_by)
        number += 1
        add_event(spark, tables, number, batch, DROPPED, its_owner)
    return read_control(spark, tables, batch_id) if control.open_batches else control


def finish_fold(spark: SparkSession, tables: Tables, number: int, fold: str, owner: str) -> int:
    """Remove the batches that a complete fold has copied; may be done again."""
    for name in tables.batch_tables():
        drop_batches(spark, name, lambda batch: not batch.startswith(FOLD))
    add_event(spark, tables, number + 1, fold, CLOSED, owner)
    return number + 1


def open_batch(
    spark: SparkSession, tables: Tables, seen: Control, batch_id: str, owner: str, bound: str | None
) -> int:
    """Open the batch and return the number of its row; refused if anyone wrote since ``seen``.

    Rows are added before they are read back. Of two runs that open at once each sees the other
    or is seen by it, so at most one goes on.
    """
    number = seen.last_number + 1
    add_event(spark, tables, number, batch_id, OPEN, owner, bound=bound)
    now = read_control(spark, tables, batch_id)
    alone = [batch for batch, _, _ in now.open_batches] == [batch_id]
    if not alone or now.epoch != seen.epoch or now.rows != seen.rows + 1:
        add_event(spark, tables, now.last_number + 1, batch_id, DROPPED, owner)
        raise OpenBatchError(f"another run wrote to the tables of {tables.landing}; run again")
    return number


def fold_if_long(spark: SparkSession, tables: Tables, number: int) -> None:
    """Fold the control table if its tail is long. For a run that has just opened its batch under ``number``:
    whoever else comes until it ends is refused and has nothing to say that could be lost."""
    epoch = latest_epoch(spark, tables.control)
    if number - epoch >= TAIL_EVENTS:
        fold_log(spark, tables.control, CONTROL_SCHEMA, events(spark, tables), number)


def read_watermark(spark: SparkSession, tables: Tables) -> DataFrame:
    """State after the last run; no row before the first."""
    saved = F.col("last_successful_watermark").isNotNull()
    state = F.struct(*WATERMARK_SCHEMA.names)
    latest = events(spark, tables).agg(F.max_by(state, F.when(saved, F.col("number"))).alias("state"))
    return latest.filter("state is not null").select("state.*")
