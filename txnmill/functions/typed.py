"""Typed readings of the landed text. All casts are ``try_`` forms: ANSI mode stays on."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmill.functions.times import parse_iso
from txnmill.profiles import ACCOUNT_REGEX
from txnmill.schema import MONEY


def money(column: Column) -> Column:
    """decimal(18,2), rounded half up; null when the text is no number or too large."""
    return column.try_cast(MONEY)


def account_number(column: Column) -> Column:
    return F.regexp_extract(column, ACCOUNT_REGEX, 1).try_cast("int")


def with_typed_columns(landing: DataFrame) -> DataFrame:
    """Landed columns plus ``amount`` and ``transaction_ts``."""
    return landing.withColumns(
        {
            "amount": money(F.col("amount_raw")),
            "transaction_ts": parse_iso(F.col("transaction_date")),
        }
    )


def computed_once(rows: DataFrame) -> DataFrame:
    """The same rows through ``inline``, one struct to a row.

    Spark pushes a filter through a projection by repeating the projected expressions wherever
    the filter names them; behind cleaning, a filter on the rules would clean the same text dozens
    of times per row. A generator stops that. It also stops column pruning, so it is for lazy
    filters on cleaned rows only; the jobs stage their rows and do without it.
    """
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))
