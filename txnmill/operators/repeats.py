"""Duplicate flags by natural key, within a load and against earlier loads.

Per key the row with the smallest id is the original and every other row is a
duplicate; a key that an earlier load already stored makes all its rows duplicates.

The plain plan is one shuffle by key and a ``row_number``. It would put all copies of
one transaction into one task, so keys with very many copies take a second path: each
input partition first ranks its own copies, and only the winners of the partitions meet
under the key.

A 64-bit hash of the key leads wherever rows are sorted by key: comparing it settles
nearly every comparison. The key columns follow, so a collision never changes a flag.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnmill.operators.skew import HEAVY_ROWS, few_hashes, heavy_key_hashes, join_keys, with_key_hash
from txnmill.schema import NATURAL_KEY

HASHED_KEY = ["key_hash", *NATURAL_KEY]


def natural_key_text(rows: DataFrame) -> DataFrame:
    """The key as one text, nulls as empty. For display: joins use the nine columns,
    because a separator inside a merchant name can make two texts collide."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in NATURAL_KEY]
    return rows.withColumn("natural_key", F.concat_ws("||", *parts))


def known_keys(bronze: DataFrame, columns: Sequence[str] = NATURAL_KEY) -> DataFrame:
    """Distinct natural keys of stored rows."""
    return bronze.select(*columns).dropDuplicates(list(columns))


def with_seen_before(
    rows: DataFrame,
    keys: DataFrame,
    row_count: int | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Flag rows whose key is among the distinct ``keys``. Valid rows have no null in
    the key (each column has a "missing" rule), so plain equality is enough."""
    marked = keys.withColumn("existing_duplicate", F.lit(True))
    joined = join_keys(rows, marked, keys.columns, "left", row_count, heavy_rows)
    return joined.withColumn(
        "existing_duplicate", F.coalesce("existing_duplicate", F.lit(False))
    )


def _flag(rows: DataFrame, keys: list[str], earlier: DataFrame | None) -> DataFrame:
    """Window by ``keys``; the join with earlier keys is partitioned the same way, so
    both cost one shuffle of the rows. Heavy keys were dealt with before."""
    order = Window.partitionBy(*keys).orderBy("transaction_id")
    repeat = F.row_number().over(order) > 1
    if earlier is None:
        return rows.withColumn("is_duplicate", repeat)
    seen = with_seen_before(rows, earlier, row_count=0)
    return seen.withColumn("is_duplicate", F.col("existing_duplicate") | repeat)


def _flag_heavy(rows: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """Two rounds. Winners of round one share slice -1 and meet there; the others keep
    their input partition as slice, so they stay spread out. A partition id does not
    change when a task is run again, which keeps both rounds consistent."""
    by_slice = Window.partitionBy(*HASHED_KEY, "slice").orderBy("transaction_id")
    ranked = (
        rows.withColumn("slice", F.spark_partition_id())
        .withColumn("leads", F.row_number().over(by_slice) == 1)
        .withColumn("slice", F.when(F.col("leads"), F.lit(-1)).otherwise(F.col("slice")))
    )
    if earlier is not None:
        earlier = earlier.withColumn("slice", F.lit(-1))
    return _flag(ranked, [*HASHED_KEY, "slice"], earlier).withColumn(
        "is_duplicate", F.col("is_duplicate") | ~F.col("leads")
    )


def mark_duplicates(
    rows: DataFrame,
    stored: DataFrame | None = None,
    row_count: int | None = None,
    heavy_rows: int = HEAVY_ROWS,
    cluster_by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Add ``is_duplicate`` to valid rows.

    ``stored`` holds the bronze rows of former loads. A caller that knows the number of
    rows, or a bound of it, passes it: below ``heavy_rows`` no key can be heavy and the
    search for heavy keys, a job over the key columns, is left out.

    ``cluster_by`` names columns that follow from the key; the rows are then shuffled by
    these into ``partitions`` instead of by the whole key, so that one shuffle also lays
    them out for writing. It is meant for loads without stored rows.
    """
    columns = [*rows.columns, "is_duplicate"]
    hashed = with_key_hash(rows, NATURAL_KEY)
    earlier = None
    if stored is not None:
        earlier = known_keys(with_key_hash(stored, NATURAL_KEY), HASHED_KEY)

    def flag_usual(part: DataFrame) -> DataFrame:
        if cluster_by:
            part = part.repartition(partitions, *cluster_by)
        return _flag(part, [*cluster_by, *HASHED_KEY], earlier).select(columns)

    if row_count is not None and row_count < heavy_rows:
        return flag_usual(hashed)
    hashes = heavy_key_hashes(hashed.select("key_hash"), heavy_rows)
    if not hashes:
        return flag_usual(hashed)
    heavy = few_hashes(rows, hashes)
    usual = flag_usual(hashed.join(heavy, "key_hash", "left_anti"))
    spread = _flag_heavy(hashed.join(heavy, "key_hash", "left_semi"), earlier)
    return usual.unionByName(spread.select(columns))
