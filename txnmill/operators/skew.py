"""Keys that very many rows share.

"Heavy" keys are found by a frequent-items sketch of key hashes. A task keeps at most ``TRACKED`` hashes with
counts (under 200 KB), and what is shuffled are these sketches, merged in groups before they meet; the hashes of the
rows are not. The search is one job over the key columns, run when a plan is built, and gives the driver at most
``LISTED`` hashes, which bounds the broadcast of the list as well.

The sketch's counts are never too low and at most ``3.5 / TRACKED`` of all rows too high, and a key with twice that
share is always among them. So a key of ``heavy_rows`` rows is found for certain up to some 2,000 times as many rows in
all, and beyond that one with a share of 1/2,340; what is smaller is no more than a few of the tasks' usual shares.
The list chooses between two ways to one result: rows are always compared by the key itself, so a hash
collision, or a key that the list has or lacks, never changes a result.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One task handles this many rows of a key without trouble (some 200 MB).
HEAVY_ROWS = 1_000_000

TRACKED = 16_384
LISTED = 10_000
MERGERS = 256


def with_key_hash(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.withColumn("key_hash", F.xxhash64(*keys))


def key_sketch(hashed: DataFrame) -> DataFrame:
    """One row with the sketch of ``key_hash``, none without rows. Tasks' sketches are merged in ``MERGERS`` groups first."""
    merger = F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("merger")
    by_merger = hashed.groupBy(merger).agg(F.expr(f"approx_top_k_accumulate(key_hash, {TRACKED})").alias("sketch"))
    # grouped, because the function fails where it is to combine nothing
    merged = by_merger.groupBy(F.lit(0).alias("all"))
    return merged.agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch")).drop("all")


def heavy_key_hashes(hashed: DataFrame, heavy_rows: int = HEAVY_ROWS) -> list[int]:
    """Hashes of the keys that so many rows share, most frequent first. Runs one job."""
    top = F.expr(f"approx_top_k_estimate(sketch, {LISTED})").alias("top")
    frequent = key_sketch(hashed).select(top).first()
    return [item["item"] for item in frequent["top"] if item["count"] >= heavy_rows] if frequent else []


def few_hashes(rows: DataFrame, hashes: Sequence[int]) -> DataFrame:
    """The listed hashes as a frame to broadcast."""
    return F.broadcast(rows.sparkSession.createDataFrame([(h,) for h in hashes], "key_hash long"))


def join_keys(
    rows: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    how: str,
    row_count: int | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Join ``rows`` with ``keys``, which holds each key once; ``how`` is a left join.

    Rows of heavy keys stay where they are and meet their few keys by broadcast; only the
    others are shuffled. Adaptive execution cannot split such rows itself when the other
    side comes out of an aggregation, as a distinct set of keys does. A caller that knows
    a bound of the row count below ``heavy_rows`` spares the search for heavy keys.
    """
    on = list(on)
    if row_count is not None and row_count < heavy_rows:
        return rows.join(keys, on, how)
    hashed = with_key_hash(rows, on)
    hashes = heavy_key_hashes(hashed.select("key_hash"), heavy_rows)
    if not hashes:
        return rows.join(keys, on, how)
    heavy = few_hashes(rows, hashes)
    usual = hashed.join(heavy, "key_hash", "left_anti").drop("key_hash")
    spread = hashed.join(heavy, "key_hash", "left_semi").drop("key_hash")
    few = with_key_hash(keys, on).join(heavy, "key_hash", "left_semi").drop("key_hash")
    return usual.join(keys, on, how).unionByName(spread.join(F.broadcast(few), on, how))
