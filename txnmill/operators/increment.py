"""What is new since the last load: time bound, known ids, next watermark."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmill.functions.times import days_before, format_iso, parse_iso, parse_iso_lenient
from txnmill.operators.skew import HEAVY_ROWS, join_keys


def cleaned_id() -> Column:
    """The id in the form in which landed ids are compared, whoever wrote them."""
    return F.upper(F.trim("transaction_id")).alias("transaction_id")


def known_ids(landing: DataFrame) -> DataFrame:
    """Distinct non-null ids of landed rows, in the cleaned form."""
    return (
        landing.select(cleaned_id())
        .filter(F.col("transaction_id").isNotNull())
        .dropDuplicates(["transaction_id"])
    )


def new_rows(
    landing: DataFrame,
    ids: DataFrame,
    row_count: int | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Rows whose id is not among the distinct ``ids``. A null id equals nothing, so it is
    always new. One id, such as an empty one, may stand in very many rows."""
    return join_keys(landing, ids, ["transaction_id"], "left_anti", row_count, heavy_rows)


def with_effective_bound(state: DataFrame) -> DataFrame:
    """Saved watermark minus the lookback, as ISO-Z text next to the state."""
    saved = parse_iso(F.col("last_successful_watermark"))
    bound = saved - F.make_dt_interval(F.col("lookback_days"))
    return state.withColumn("effective_watermark", format_iso(bound))


def max_event_time(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.max("transaction_ts").alias("max_ts"))


def next_watermark(latest: str | None, saved: str | None, monotonic: bool = True) -> str | None:
    """Latest event time of the new bronze rows, else the saved watermark, as ISO-Z text, which
    sorts by time. ``monotonic`` keeps a load of late rows only from moving it back."""
    if latest is None or saved is None:
        return latest or saved
    return max(latest, saved) if monotonic else latest


def late_rows(records: DataFrame, watermark: DataFrame, lookback_days: int = 1) -> DataFrame:
    """Records that an incremental read never sees, with the reason ``left_out_because``: dated
    before the lookback reaches, or with a date that cannot be read. This is exactly what
    ``since`` leaves out. ``watermark`` is the one-row result of :func:`max_event_time`."""
    bound = watermark.select(days_before(F.col("max_ts"), lookback_days)).scalar()
    time = parse_iso_lenient(F.col("transaction_date"))
    reason = F.when(time < bound, "before the lookback").when(
        time.isNull() & bound.isNotNull(), "date cannot be read"
    )
    return records.withColumn("left_out_because", reason).filter("left_out_because is not null")
