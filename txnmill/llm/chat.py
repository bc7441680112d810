"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

Logs often hold a conversation several times, each time with more turns. A rolling hash over the
turns marks every prefix of every conversation; a conversation whose whole hash is a proper prefix
of another one is dropped by an anti-join, and of equal ones the smallest id stays. What is left is
rendered.

The rolling hash is the exclusive or of two 64-bit hashes of each turn with its place, so it is
summed in any order: first inside parts of ``part_turns`` turns, then over the parts. A conversation
of any length is spread over its parts, and each part renders to one row; rows of a conversation
joined in order of ``part`` are its text. Prefix hashes are made distinct before they meet the
conversations, one row for each content, so a first turn or a whole conversation that a third of the
log shares is one row on either side.

Defined cases: rows without a conversation id belong to none and are left out. Fully equal turns of
a conversation count once; turns go by number, null last, ties by role and text. A null role is
rendered as ``unknown``, a null text as nothing; for the hash null and empty differ. Other columns
are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnmill.llm.common import staged

PART_TURNS = 1024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"  # fixed marks of the rendered form


def collapse(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    part_turns: int = PART_TURNS,
) -> tuple[DataFrame, DataFrame]:
    """(numbered turns, maximal conversations): conv_id, part, place, role, text and conv_id,
    n_turns, copies. ``copies`` counts the equal conversations."""
    log = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    ).filter("conv_id is not null")
    placed = staged(_placed(log, part_turns), "turns")
    hashed = placed.select(
        "conv_id",
        "part",
        "place",
        *(_turn_hash(i).alias(f"h{i}") for i in (1, 2)),
    )
    running = Window.partitionBy("conv_id", "part").orderBy("place")
    inside = hashed.select(
        "conv_id", "part", "place", *(F.expr(f"bit_xor(h{i})").over(running).alias(f"p{i}") for i in (1, 2))
    )
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = hashed.groupBy("conv_id", "part").agg(
        *(F.bit_xor(f"h{i}").alias(f"s{i}") for i in (1, 2)), F.max("place").alias("last")
    )
    heads = sums.select(
        "conv_id",
        "part",
        *(F.coalesce(F.expr(f"bit_xor(s{i})").over(before), F.lit(0)).alias(f"b{i}") for i in (1, 2)),
        F.max("last").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    heads = staged(heads, "heads")
    prefixes = inside.join(heads, ["conv_id", "part"]).select(
        "conv_id",
        "place",
        "n_turns",
        *(F.col(f"p{i}").bitwiseXOR(F.col(f"b{i}")).alias(f"p{i}") for i in (1, 2)),
    )
    prefixes = staged(prefixes, "prefixes")
    key = ["place", "p1", "p2"]
    whole = (
        prefixes.filter("place = n_turns")
        .groupBy(*key)
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    )
    longer = prefixes.filter("place < n_turns").select(*key).distinct()
    kept = whole.join(longer, key, "left_anti")
    return placed, staged(kept.select("conv_id", F.col("place").alias("n_turns"), "copies"), "kept")


def _turn_hash(i: int) -> Column:
    cells = [
        x for c in ("role", "text") for x in (F.col(c).isNull(), F.coalesce(F.col(c), F.lit("")))
    ]
    return F.xxhash64(F.lit(i), F.col("place"), *cells)


def _placed(log: DataFrame, part_turns: int) -> DataFrame:
    """Distinct turns with their place from 1 and their part.

    Places are counted inside runs of turn numbers and moved by the runs before, so that no task
    gets more than the turns of one run of a conversation.
    """
    run = F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(2**62)).cast("long")
    turns = log.distinct().withColumn("run", run)
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    inside = F.row_number().over(Window.partitionBy("conv_id", "run").orderBy(*order))
    counts = turns.groupBy("conv_id", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select(
        "conv_id", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("moved")
    )
    place = (F.col("inside") + F.col("moved")).cast("long")
    return (
        turns.withColumn("inside", inside)
        .join(moved, ["conv_id", "run"])
        .select("conv_id", place.alias("place"), "role", "text")
        .withColumn("part", F.expr(f"(place - 1) div {part_turns}"))
    )


def render(placed: DataFrame, kept: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, part, n_turns, copies, text): the kept conversations, a row per part."""
    parts = kept.withColumn("part", F.explode(F.expr(f"sequence(0, (n_turns - 1) div {part_turns})")))
    rows = placed.join(parts, ["conv_id", "part"])
    turn = F.concat(
        F.lit(OPEN),
        F.coalesce("role", F.lit("unknown")),
        F.lit("\n"),
        F.coalesce("text", F.lit("")),
        F.lit(CLOSE),
    )
    pieces = F.array_sort(F.collect_list(F.struct("place", turn.alias("turn"))))
    return (
        rows.groupBy("conv_id", "part", "n_turns", "copies")
        .agg(pieces.alias("pieces"))
        .select(
            "conv_id",
            F.col("part").cast("long").alias("part"),
            "n_turns",
            "copies",
            F.array_join(F.col("pieces.turn"), "").alias("text"),
        )
    )


def formatted(turns: DataFrame, part_turns: int = PART_TURNS, **columns: str) -> DataFrame:
    """Maximal conversations of the log, rendered; see ``collapse`` and ``render``."""
    placed, kept = collapse(turns, part_turns=part_turns, **columns)
    return render(placed, kept, part_turns)
