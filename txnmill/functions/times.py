"""Timestamps written as ``YYYY-MM-DDTHH:MM:SSZ``; all of it assumes a UTC session."""

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnmill.profiles import TIMESTAMP_PATTERN

# Single letters accept one or two digits, which is what the source-side bound tolerates.
LENIENT_PATTERN = "yyyy-M-d'T'H:m:s'Z'"


def parse_iso(column: Column) -> Column:
    """Strict parse; null for anything that is not a real date and time."""
    return F.try_to_timestamp(column, F.lit(TIMESTAMP_PATTERN))


def parse_iso_lenient(column: Column) -> Column:
    return F.try_to_timestamp(column, F.lit(LENIENT_PATTERN))


def format_iso(column: Column) -> Column:
    return F.date_format(column, TIMESTAMP_PATTERN)


def days_before(column: Column, days: int) -> Column:
    return column - F.make_dt_interval(F.lit(days))


def utc_now() -> str:
    """The driver's clock in whole seconds, for stamping a run."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
