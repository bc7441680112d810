"""Daily summary per account."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnmill.schema import MONEY

ACCOUNT_DAY = ["account_id", "transaction_date"]
CATEGORY_DAY = ACCOUNT_DAY + ["merchant_category"]

SUMMARY_COLUMNS = ACCOUNT_DAY + [
    "total_debit_amount",
    "total_credit_amount",
    "net_amount",
    "transaction_count",
    "distinct_merchants",
    "top_category",
    "currencies",
]


def summary_base(bronze: DataFrame) -> DataFrame:
    """Completed originals, with the event day as ``transaction_date``."""
    return bronze.filter((F.col("status") == "completed") & ~F.col("is_duplicate")).select(
        "account_id",
        F.to_date("transaction_ts").alias("transaction_date"),
        "amount",
        "transaction_type",
        "merchant_name",
        "merchant_category",
        "currency",
    )


def _amount_of(kind: str) -> Column:
    return F.when(F.col("transaction_type") == kind, F.col("amount")).otherwise(
        F.lit(0).cast(MONEY)
    )


def _as_money(total: Column) -> Column:
    return F.round(total, 2).cast(MONEY)


def _currency_text(currencies: Column) -> Column:
    return F.concat_ws(",", F.array_sort(currencies))


def daily_metrics(base: DataFrame) -> DataFrame:
    """Figures of a day without its top category, by the plan of :func:`daily_summary`."""
    return daily_summary(base).drop("top_category")


def category_spend(base: DataFrame) -> DataFrame:
    """Amount per account, day and category; debits and credits both count."""
    return base.groupBy(CATEGORY_DAY).agg(F.sum("amount").alias("category_amount"))


def ranked_categories(spend: DataFrame) -> DataFrame:
    order = Window.partitionBy(*ACCOUNT_DAY).orderBy(
        F.col("category_amount").desc(), F.col("merchant_category").asc()
    )
    return spend.select(*CATEGORY_DAY, F.row_number().over(order).alias("rn"))


def top_category(ranked: DataFrame) -> DataFrame:
    return ranked.filter("rn = 1").select(
        *ACCOUNT_DAY, F.col("merchant_category").alias("top_category")
    )


def daily_summary(base: DataFrame) -> DataFrame:
    """The whole summary, with nothing but merchant names in a large shuffle.

    Merchant names are free text, so there may be nearly as many (account, day, merchant)
    groups as rows. They are counted on their own, which shuffles only these three
    columns. Amounts never meet the merchant: they are combined on the map side to account,
    day, category and currency, of which there are few, and folded from there. The two
    scans share only the columns that name and filter the day.

    Sets of currencies, which spoil hash aggregation of many groups, start on the few rows
    that are left. Both sides of the join have one row per account and day; it is null-safe,
    so that no filter is derived for one side only and a base with shuffles of its own is
    computed once for both.
    """
    merchants = base.groupBy(ACCOUNT_DAY).agg(
        F.countDistinct("merchant_name").alias("distinct_merchants")
    )
    sums = ["debit", "credit", "spend", "n"]
    amounts = base.groupBy(CATEGORY_DAY + ["currency"]).agg(
        F.sum(_amount_of("debit")).alias("debit"),
        F.sum(_amount_of("credit")).alias("credit"),
        F.sum("amount").alias("spend"),
        F.count("*").alias("n"),
    )
    categories = amounts.groupBy(CATEGORY_DAY).agg(
        *[F.sum(name).alias(name) for name in sums],
        F.collect_set("currency").alias("currencies"),
    )
    # Largest spend first (days without any amount last), then the category name.
    rank = F.struct(F.col("spend").isNull(), -F.col("spend"), F.col("merchant_category"))
    debit, credit = F.sum("debit"), F.sum("credit")
    days = categories.groupBy(ACCOUNT_DAY).agg(
        _as_money(debit).alias("total_debit_amount"),
        _as_money(credit).alias("total_credit_amount"),
        _as_money(credit - debit).alias("net_amount"),
        F.sum("n").alias("transaction_count"),
        F.min_by("merchant_category", rank).alias("top_category"),
        _currency_text(F.array_distinct(F.flatten(F.collect_list("currencies")))).alias(
            "currencies"
        ),
    )
    same_day = [days[name].eqNullSafe(merchants[name]) for name in ACCOUNT_DAY]
    columns = [days[name] for name in ACCOUNT_DAY] + SUMMARY_COLUMNS[len(ACCOUNT_DAY) :]
    return days.join(merchants, same_day, "left").select(columns)


def stamped(summary: DataFrame) -> DataFrame:
    return summary.withColumn("updated_at", F.current_timestamp())
