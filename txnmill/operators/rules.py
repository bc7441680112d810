"""The twelve validation rules.

A rule is an ordered list of checks; the first check that fires gives the message.
Everything is a built-in column expression, evaluated in one projection.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmill.functions.text import missing
from txnmill.functions.typed import with_typed_columns
from txnmill.profiles import (
    ACCOUNT_REGEX,
    COUNTRY_CODES,
    COUNTRY_REGEX,
    CURRENCIES,
    DATE_REGEX,
    HIGHEST_ACCOUNT,
    ID_REGEX,
    LOWEST_ACCOUNT,
    MERCHANT_CATEGORIES,
    STATUSES,
    TRANSACTION_TYPES,
    Profile,
)


def first_message(*checks: tuple[Column, str]) -> Column:
    """Message of the first check whose condition holds, else null."""
    return F.coalesce(*[F.when(condition, F.lit(message)) for condition, message in checks])


def _not_in(name: str, allowed: list[str]) -> Column:
    """``NOT IN`` as SQL text: one call to the JVM instead of one per listed value."""
    listed = ", ".join(f"'{value}'" for value in allowed)
    return F.expr(f"{name} NOT IN ({listed})")


def _one_of(name: str, allowed: list[str]) -> Column:
    return first_message(
        (missing(F.col(name)), f"{name} is missing"),
        (_not_in(name, allowed), f"{name} is invalid"),
    )


def _amount_rule(profile: Profile) -> Column:
    raw, amount = F.col("amount_raw"), F.col("amount")
    sign = (amount <= 0, "amount must be strictly greater than 0")
    form = (~raw.rlike(profile.amount_regex), profile.amount_form_message)
    return first_message(
        (missing(F.trim(raw)), "amount is missing"),
        (amount.isNull(), profile.amount_type_message),
        *((sign, form) if profile.sign_before_form else (form, sign)),
    )


# The messages below are fixed values.
def rule_columns(profile: Profile) -> dict[str, Column]:
    """The rules in reporting order, over landed text plus ``amount`` and ``transaction_ts``."""
    txn_id, account, date = F.col("transaction_id"), F.col("account_id"), F.col("transaction_date")
    ts, merchant, country = F.col("transaction_ts"), F.col("merchant_name"), F.col("country_code")
    first_ts, last_ts = (F.lit(t).cast("timestamp") for t in (profile.first_ts, profile.last_ts))
    return {
        "err_transaction_id": first_message(
            (missing(txn_id), "transaction_id is missing"),
            (~txn_id.rlike(ID_REGEX), "transaction_id must match ^TXN-[A-Z0-9]+$"),
        ),
        "err_account_id": first_message(
            (missing(account), "account_id is missing"),
            (~account.rlike(ACCOUNT_REGEX), r"account_id must match ^ACC-\d{4}$"),
            # Four digits each by now, so text order is number order.
            (
                ~account.between(LOWEST_ACCOUNT, HIGHEST_ACCOUNT),
                f"account_id must be between {LOWEST_ACCOUNT} and {HIGHEST_ACCOUNT}",
            ),
        ),
        "err_transaction_date_format": first_message(
            (missing(date), "transaction_date is missing"),
            (
                ~date.rlike(DATE_REGEX),
                "transaction_date must match strict ISO 8601 format YYYY-MM-DDTHH:MM:SSZ",
            ),
        ),
        "err_transaction_date_value": first_message(
            (
                ts.isNull() & date.rlike(DATE_REGEX),
                "transaction_date is not a valid calendar date/time",
            ),
        ),
        "err_transaction_date_range": first_message(
            (~ts.between(first_ts, last_ts), profile.range_message),
        ),
        "err_amount": _amount_rule(profile),
        "err_currency": _one_of("currency", CURRENCIES),
        "err_transaction_type": _one_of("transaction_type", TRANSACTION_TYPES),
        "err_merchant_name": first_message(
            (missing(merchant), "merchant_name is missing"),
            (
                ~merchant.rlike(r"\S"),
                "merchant_name must contain at least one non-whitespace character",
            ),
        ),
        "err_merchant_category": _one_of("merchant_category", MERCHANT_CATEGORIES),
        "err_status": _one_of("status", STATUSES),
        "err_country_code": first_message(
            (missing(country), "country_code is missing"),
            (~country.rlike(COUNTRY_REGEX), "country_code must be exactly two uppercase letters"),
            (
                _not_in("country_code", COUNTRY_CODES),
                "country_code must be an assigned ISO 3166-1 alpha-2 code",
            ),
        ),
    }


def with_rule_messages(landing: DataFrame, profile: Profile) -> DataFrame:
    """Typed columns plus one ``err_*`` column per rule."""
    return with_typed_columns(landing).withColumns(rule_columns(profile))


def validate(landing: DataFrame, profile: Profile) -> DataFrame:
    """Typed columns, rule messages, and their summary.

    ``is_valid`` is stated on the messages, not on the array: array filters are
    interpreted row by row, so the array is only computed where a caller selects it.
    """
    checked = with_rule_messages(landing, profile)
    messages = [name for name in checked.columns if name.startswith("err_")]
    return checked.withColumns(
        {
            "error_array": F.array_compact(F.array(*messages)),
            "error_reason": F.concat_ws("; ", *messages),
            "is_valid": F.coalesce(*messages).isNull(),
        }
    )
