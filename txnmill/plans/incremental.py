"""Incremental load: what came since the saved watermark, once.

Order of a batch: stage what was read; drop what landed in earlier batches; open the batch in
the control table; write bronze, quarantine, landing and what later batches are compared with
(``plans/history.py``); add the row that says it has landed.
Rows count from that row on. A run that died anywhere before can be run again: the batch is still
open, what it stored is cleared, and the watermark has not moved. See ``plans/batches.py``.
"""

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txnmill.functions.times import utc_now
from txnmill.operators import increment, landing, repeats, routing, rules
from txnmill.operators.skew import HEAVY_ROWS
from txnmill.plans import batches
from txnmill.plans.batches import BatchResult, read_watermark
from txnmill.plans.history import BROADCAST_BYTES, add_ids, add_keys, create_history, drop_known, stored_keys
from txnmill.plans.tables import Tables, staging
from txnmill.profiles import INCREMENTAL
from txnmill.schema import (
    BRONZE_COLUMNS,
    LANDING_COLUMNS,
    QUARANTINE_COLUMNS,
    VALID_COLUMNS,
    schema_of,
)
from txnmill.session import use_utc
from txnmill.sinks.tables import add_batch, create_batch_table
from txnmill.sources.records import SOURCE_FILE, Source

LOOKBACK_DAYS = 1


def new_batch_id() -> str:
    """Sorts by time."""
    return datetime.now(timezone.utc).strftime("b%Y%m%dT%H%M%S%f")


def create_tables(spark: SparkSession, tables: Tables) -> None:
    create_batch_table(spark, tables.landing, schema_of(LANDING_COLUMNS))
    create_batch_table(spark, tables.quarantine, schema_of(QUARANTINE_COLUMNS))
    create_batch_table(spark, tables.bronze, schema_of(BRONZE_COLUMNS + ["event_date"]), ["event_date"])
    create_history(spark, tables)


def run_batch(
    spark: SparkSession,
    source: Source,
    tables: Tables,
    batch_id: str,
    saved: str | None = None,
    monotonic: bool = True,
    loaded_at: str | None = None,
    heavy_rows: int = HEAVY_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    owner: str | None = None,
    bound: str | None = None,
    lookback_days: int | None = None,
) -> BatchResult:
    """Store the new rows of one batch. Without new rows nothing is stored.

    A batch id that has landed returns its result and changes nothing. ``owner`` names the writer:
    a later run under that name clears what this one leaves if it dies. Without a name only a run
    under the same batch id does. ``lookback_days`` is given by loads that keep a watermark.
    """
    use_utc(spark)
    if batch_id.startswith(batches.FOLD):
        raise ValueError(f"ids that start with {batches.FOLD!r} are for compaction")
    owner = owner or f"run-{uuid.uuid4().hex}"
    create_tables(spark, tables)
    control = batches.read_control(spark, tables, batch_id)
    if control.own:
        return control.own
    control = batches.clear_own_leftovers(spark, tables, control, batch_id, owner)
    with staging(spark, tables, batch_id) as stage:
        incoming, read = _staged_incoming(stage, source, loaded_at or utc_now())
        left_out = None if source.seen is None else source.seen.get.get("n", 0) - read["n"]
        fresh, found = incoming, read
        if control.landed_batches and read["n"]:
            new = drop_known(incoming, spark.table(tables.ids), read["n"], broadcast_bytes, heavy_rows, cleaned=True)
            fresh, found = _measured(stage, new, "fresh")
        watermark = increment.next_watermark(found["latest"], saved, monotonic)
        result = BatchResult(batch_id, read["n"], found["n"], watermark, left_out)
        state = _state(result, lookback_days)
        if found["n"] == 0:
            if state.get("last_successful_watermark"):
                number = _folded_between(spark, tables, control, batch_id, owner, source)
                batches.add_event(spark, tables, number + 1, batch_id, batches.IDLE, owner, bound=bound, **state)
                if source.ledger:
                    source.ledger.enter(incoming, number + 1)
            return result
        number = batches.open_batch(spark, tables, control, batch_id, owner, bound)
        _fold_logs(spark, tables, number, source)
        stored = None
        if control.landed_batches and found["valid"]:
            rows = routing.valid(fresh)
            stored = stored_keys(spark, tables, stage, rows, found["valid"], found["days"], broadcast_bytes)
        _store(spark, tables, batch_id, fresh, found["valid"], stored, heavy_rows)
        batches.add_event(spark, tables, number + 1, batch_id, batches.LANDED, owner, bound=bound, **state)
        if source.ledger:
            source.ledger.enter(incoming, number + 1)
    return result


def _fold_logs(spark: SparkSession, tables: Tables, number: int, source: Source) -> None:
    batches.fold_if_long(spark, tables, number)
    if source.ledger:
        source.ledger.fold_if_long(spark, number)


def _folded_between(spark: SparkSession, tables: Tables, control, batch_id: str, owner: str, source: Source) -> int:
    """Fold a long control table although there is nothing to store, so that idle runs do not make it long.
    Returns the last number in use."""
    if control.last_number + 1 - control.epoch < batches.TAIL_EVENTS:
        return control.last_number
    number = batches.open_batch(spark, tables, control, batch_id, owner, None)
    _fold_logs(spark, tables, number, source)
    batches.add_event(spark, tables, number + 1, batch_id, batches.DROPPED, owner)
    return number + 1


def _state(result: BatchResult, lookback_days: int | None) -> dict:
    state = {
        "read_rows": result.read_rows,
        "left_out_rows": result.left_out_rows,
        "new_rows": result.new_rows,
        "watermark": result.watermark,
    }
    if lookback_days is not None:
        state |= {
            "last_successful_watermark": result.watermark,
            "rows_processed": result.new_rows,
            "lookback_days": lookback_days,
        }
    return state


def _staged_incoming(stage, source: Source, loaded_at: str) -> tuple[DataFrame, dict]:
    more = [SOURCE_FILE] if source.ledger else []
    landed = landing.stamp(landing.land(source.records, INCREMENTAL, more), source.label, loaded_at)
    columns = list(dict.fromkeys(VALID_COLUMNS + QUARANTINE_COLUMNS + ["is_valid"] + more))
    return _measured(stage, rules.validate(landed, INCREMENTAL).select(columns), "incoming")


def _measured(stage, rows: DataFrame, step: str) -> tuple[DataFrame, dict]:
    """Stage the rows and count them on the way, with the days of the valid ones, a year of them at most.
    Dates of valid rows sort as text."""
    seen = Observation()
    observed = rows.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("is_valid"), 1)).alias("valid"),
        F.max(F.when(F.col("is_valid"), F.col("transaction_date"))).alias("latest"),
        F.collect_set(F.when(F.col("is_valid"), F.to_date("transaction_ts"))).alias("days"),
    )
    staged = stage.write(observed, step)
    return staged, {"n": 0, "valid": 0, "latest": None, "days": []} | seen.get


def _store(spark, tables, batch_id, fresh, valid, stored, heavy_rows) -> None:
    """All tables of the batch, written side by side: they are small or as large as the batch, and none of them
    counts before the batch has landed."""
    rows = routing.valid(fresh)
    bronze = repeats.mark_duplicates(rows, stored, row_count=valid, heavy_rows=heavy_rows)
    bronze = bronze.withColumn("event_date", F.to_date("transaction_ts"))
    # Adaptive execution sizes the files: large days are split, small ones kept whole.
    writes = [
        lambda: add_batch(bronze.hint("rebalance", "event_date"), tables.bronze, batch_id, ["event_date"]),
        lambda: add_batch(fresh.filter("not is_valid").select(QUARANTINE_COLUMNS), tables.quarantine, batch_id),
        lambda: add_batch(fresh.select(LANDING_COLUMNS), tables.landing, batch_id),
        lambda: add_ids(spark, tables, batch_id, fresh),
        lambda: add_keys(tables, batch_id, rows),
    ]
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            done.result()


def incremental_load(
    spark: SparkSession,
    read: Callable[[str | None], Source],
    tables: Tables,
    lookback_days: int = LOOKBACK_DAYS,
    batch_id: str | None = None,
    **options,
) -> BatchResult:
    """Read from the saved watermark minus the lookback (everything on the first run),
    store what is new and move the watermark. ``options`` go to :func:`run_batch`."""
    use_utc(spark)
    batch_id = batch_id or new_batch_id()
    state = read_watermark(spark, tables).withColumn("lookback_days", F.lit(lookback_days))
    last = increment.with_effective_bound(state).first()
    saved = last["last_successful_watermark"] if last else None
    bound = last["effective_watermark"] if last else None
    return run_batch(
        spark, read(bound), tables, batch_id, saved=saved, bound=bound, lookback_days=lookback_days, **options
    )
