"""K-d tree partitioning into shards of equal bytes, in DataFrame functions only.

A node is cut at the weighted median of its widest metadata dimension, where a document weighs its
bytes and width is the range of a dimension in the node over its range in the table. A node that
is to give ``n`` leaves sends ``n // 2`` of them, and that share of its bytes, to the left.

Medians are found by counting, for all nodes of a level at once. Each dimension is mapped to
36 bits, and a pass sums the bytes of the 4096 next smaller intervals of each node: a result of
nodes times 4096 rows at most, however many documents there are. A pass ends at the interval that
holds the median, and the next one looks inside it, until what is left to cut weighs no more than
``tolerance`` of a leaf. Documents of one place in the dimension are cut further by a hash of the text,
so that equal texts stay together, and only a group of copies too large for the tolerance by a hash
of the id.

Slots are counted inside hash buckets of a shard and moved by the buckets before.

Defined cases: a null text has no bytes and weighs 1, as the empty text does; its checksum is 0.
Rows with equal ids are separate documents. Copies that agree even in id stay together. An empty
table gives an empty result. Other columns are ignored.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnmill.llm.common import shuffle_partitions, staged, text_or_empty

DIGIT, DIGITS = 12, 3  # bits looked at in a pass, and passes to the end of a dimension
BITS = DIGIT * DIGITS
TOLERANCE = 0.002


@dataclass
class Node:
    """A node in the middle of being cut: leaves below it and how far the cut is known."""

    number: int
    leaves: int
    bytes: int
    want: float  # bytes that the left side is to get
    keys: list[str] = field(default_factory=list)  # columns, the later ones for ties
    at: int = 0  # key that is being looked at
    prefix: int = 0  # leading digits of the cut in that key
    digits: int = 0
    before: int = 0  # bytes to the left of the prefix
    fixed: list[int] = field(default_factory=list)  # cut values of the keys before
    done: bool = False
    cut: int = 0


def dimensions(text: Column) -> dict[str, Column]:
    """Metadata of a text: length on a log scale, lines, checksum."""
    return {
        "d_bytes": F.log2(F.octet_length(text) + F.lit(1.0)),
        "d_lines": F.log2(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + F.lit(1.0)),
        "d_check": F.crc32(text).cast("double"),
    }


def kd_shards(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every document."""
    text = text_or_empty(F.col(text_col))
    metadata = dimensions(text)
    meta = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(F.lit(1), text), 64 - BITS).alias("t_text"),
        F.shiftrightunsigned(F.xxhash64(F.lit(2), F.col(id_col)), 64 - BITS).alias("t_id"),
        *(d.cast("double").alias(name) for name, d in metadata.items()),
    )
    meta = _scaled(staged(meta, "metadata"), list(metadata))
    return with_slots(assigned(meta, list(metadata), shards, tolerance))


def _scaled(meta: DataFrame, dims: list[str]) -> DataFrame:
    """Dimensions mapped to whole numbers of ``BITS`` bits over their range in the table."""
    ends = meta.agg(
        *(f(d).alias(f"{d}_{name}") for d in dims for name, f in (("low", F.min), ("high", F.max)))
    ).first()
    scaled = meta
    for d in dims:
        low, high = ends[f"{d}_low"], ends[f"{d}_high"]
        span = (high - low) if low is not None and high > low else 1.0
        place = F.floor((F.col(d) - F.lit(low or 0.0)) / F.lit(span) * F.lit(float(2**BITS - 1)))
        scaled = scaled.withColumn(d, F.least(place, F.lit(2**BITS - 1)).cast("long"))
    return scaled


def assigned(meta: DataFrame, dims: list[str], shards: int, tolerance: float) -> DataFrame:
    """``meta`` with the leaf of each row as ``shard``; nodes of one level are cut together.

    A node is known by its first leaf, so leaves and their numbers are known from the start.
    """
    total = meta.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    level, cuts = {0: shards}, {}
    while inner := {first: n for first, n in level.items() if n > 1}:
        placed = meta.withColumn("node", _leaf(cuts, 0, shards))
        found = _cuts(placed, inner, dims, slack)
        cuts |= {(first, n): found.get(first) for first, n in inner.items()}
        level = {
            child: n
            for first, leaves in inner.items()
            for child, n in ((first, leaves // 2), (first + leaves // 2, leaves - leaves // 2))
        }
    return meta.withColumn("shard", _leaf(cuts, 0, shards).cast("int"))


def _leaf(cuts: dict[tuple[int, int], "Node | None"], first: int, leaves: int) -> Column:
    """First leaf of the node that a row has come to, through the cuts found so far."""
    cut = cuts.get((first, leaves))
    if cut is None:  # not cut yet, or without rows
        return F.lit(first)
    left = leaves // 2
    return F.when(_is_left(cut), _leaf(cuts, first, left)).otherwise(_leaf(cuts, first + left, leaves - left))


def _is_left(cut: Node) -> Column:
    """Whether a row lies below the cut in the order of the node's keys."""
    keys = cut.keys[: cut.at + 1]
    last = F.col(keys[-1]) < F.lit(cut.cut)
    for key, value in zip(reversed(keys[:-1]), reversed(cut.fixed), strict=True):
        last = (F.col(key) < F.lit(value)) | ((F.col(key) == F.lit(value)) & last)
    return last


def _cuts(placed: DataFrame, nodes: dict[int, int], dims: list[str], slack: float) -> dict[int, Node]:
    spans = [F.max(d) - F.min(d) for d in dims]
    stats = placed.filter(F.col("node").isin(list(nodes))).groupBy("node").agg(
        F.sum("size").alias("bytes"), *(s.alias(d) for s, d in zip(spans, dims, strict=True))
    )
    cuts: dict[int, Node] = {}
    for row in stats.collect():  # a row per node
        number, leaves = row["node"], nodes[row["node"]]
        widest = max(dims, key=lambda d: (row[d], -dims.index(d)))
        want = row["bytes"] * (leaves // 2) / leaves
        cuts[number] = Node(number, leaves, row["bytes"], want, [widest, "t_text", "t_id"])
    while todo := [c for c in cuts.values() if not c.done]:
        for cut, sums in _counted(placed, todo).items():
            _narrow(cuts[cut], sums, slack)
    return cuts


def _counted(placed: DataFrame, todo: list[Node]) -> dict[int, dict[int, int]]:
    """Bytes by the next digit of the key looked at, inside what is still open of each node."""
    digit: Column = F.lit(None).cast("long")
    for cut in todo:
        rest = BITS - cut.digits * DIGIT
        key = F.col(cut.keys[cut.at])
        open_rows = (F.col("node") == cut.number) & (F.shiftright(key, rest) == F.lit(cut.prefix))
        for name, value in zip(cut.keys, cut.fixed, strict=False):
            open_rows &= F.col(name) == F.lit(value)
        digit = F.when(open_rows, F.shiftright(key, rest - DIGIT).bitwiseAND(F.lit(2**DIGIT - 1))).otherwise(digit)
    rows = (
        placed.select("node", "size", digit.alias("digit"))
        .filter("digit is not null")
        .groupBy("node", "digit")
        .agg(F.sum("size").alias("bytes"))
        .collect()  # at most 4096 rows a node
    )
    found: dict[int, dict[int, int]] = {cut.number: {} for cut in todo}
    for row in rows:
        found[row["node"]][row["digit"]] = row["bytes"]
    return found


def _narrow(cut: Node, sums: dict[int, int], slack: float) -> None:
    """Move to the digit that holds the wanted weight; stop if the rest is light or at the end."""
    for digit in sorted(sums):
        if cut.before + sums[digit] >= cut.want or digit == max(sums):
            break
        cut.before += sums[digit]
    cut.prefix = cut.prefix << DIGIT | digit
    cut.digits += 1
    whole, last_digit = sums[digit], cut.digits == DIGITS
    at_end = last_digit and cut.at == len(cut.keys) - 1
    if whole <= slack or at_end:
        # the interval goes to the side that it serves better
        after = 1 if abs(cut.before + whole - cut.want) < abs(cut.before - cut.want) else 0
        cut.cut = (cut.prefix + after) << (BITS - cut.digits * DIGIT)
        cut.done = True
    elif last_digit:
        cut.fixed.append(cut.prefix)
        cut.at, cut.prefix, cut.digits = cut.at + 1, 0, 0


def with_slots(sharded: DataFrame) -> DataFrame:
    """Gapless numbers from 0 in each shard."""
    buckets = shuffle_partitions(sharded.sparkSession)
    rows = staged(
        sharded.select(
            "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).alias("bucket")
        ),
        "sharded",
    )
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    moved = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("moved"))
    slot = F.row_number().over(order) - 1
    # a row per shard and bucket, and there are as many buckets as partitions
    return (
        rows.withColumn("inside", slot)
        .join(F.broadcast(moved), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("inside") + F.col("moved")).alias("slot"))
    )
