"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents longer than the longest sequence are cut into pieces of that length and a rest. Pieces
are dealt by hash to parts of about ``part_tokens`` tokens, whose number follows from a count of
all tokens. A part is sorted by falling length and packed in one pass:

* a piece goes into the open bin with the least room that still holds it;
* without such a bin one is opened, of the length with the least cost per token that it
  can be filled with: the piece and what is left of the smaller ones;
* at the end each bin shrinks to the shortest permitted length that holds its contents.

The lengths are chosen together: a part is packed once for every set of permitted lengths that bins may be opened
with, and the packing of least cost, after bins have shrunk, is taken. So a length that is cheap by itself but leaves
room that nothing fills gives way to one that the pieces fit.

The cost of a sequence of ``c`` tokens is ``overhead + c + quadratic * c * c``: a fixed part,
a part in proportion and the part of attention. Room is whole numbers up to the longest length,
so the best bin is found by one bit operation on a mask of rooms that open bins have.

Defined cases: null, empty and wordless texts are one piece of length 0 without a bin. Rows with
equal ids are separate documents; ``row_no`` tells pieces of them apart. Other columns are
ignored. Every piece is returned once.
"""

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmill.llm.common import shuffle_partitions, staged, word_count, workers_see_package

LENGTHS = (512, 1024, 2048, 4096)
PART_TOKENS = 4_000_000
OVERHEAD, QUADRATIC = 64.0, 1 / 16384


def cost(length: int, overhead: float = OVERHEAD, quadratic: float = QUADRATIC) -> float:
    return overhead + length + quadratic * length * length


class Packer:
    """Bins of one part, opened with some of the permitted lengths; give it pieces in falling order of length."""

    def __init__(self, total: int, lengths: Sequence[int] = LENGTHS, price=cost, permitted: Sequence[int] = ()):
        self.lengths, self.left = sorted(lengths), total
        self.permitted = np.array(sorted(permitted or lengths))
        self.price = {c: price(c) for c in self.lengths}
        self.size: list[int] = []  # capacity of each bin
        self.fill: list[int] = []
        self.by_room: list[list[int]] = [[] for _ in range(self.lengths[-1] + 1)]
        self.rooms = 0  # bit r is set if an open bin has room r

    def add(self, length: int) -> tuple[int, int]:
        """(bin, offset) of the piece."""
        fits = self.rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            bins = self.by_room[room]
            at = bins.pop()
            if not bins:
                self.rooms ^= 1 << room
        else:
            room, at = self._open(length), len(self.size)
            self.size.append(room)
            self.fill.append(0)
        offset = self.fill[at]
        self.fill[at] += length
        self.left -= length
        room -= length
        if room:
            self.by_room[room].append(at)
            self.rooms |= 1 << room
        return at, offset

    def _open(self, length: int) -> int:
        """The permitted length of least cost per token that can still come to fill it."""
        return min(
            (c for c in self.lengths if c >= length),
            key=lambda c: (self.price[c] / min(c, self.left), c),
        )

    def final_sizes(self) -> np.ndarray:
        """Shortest permitted length for what each bin holds."""
        return self.permitted[np.searchsorted(self.permitted, np.array(self.fill, np.int64))]


def best_packing(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, price=cost) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece and the final size of every bin, for the set of lengths to open bins with that
    costs least. ``sizes`` fall, and none is above the longest length."""
    total = int(sum(sizes))
    best = None
    for count in range(len(lengths), 0, -1):
        for some in combinations(sorted(lengths), count):
            if some[-1] < sizes[0]:
                continue
            packer = Packer(total, some, price, lengths)
            placed = [packer.add(n) for n in sizes]
            final = packer.final_sizes()
            paid = sum(price(c) * n for c, n in zip(*(x.tolist() for x in np.unique(final, return_counts=True)), strict=True))
            if best is None or paid < best[0]:
                best = paid, placed, final
    return np.array(best[1], np.int64), best[2]


def pieces(docs: DataFrame, id_col: str, length: Column, longest: int) -> DataFrame:
    """(doc_id, row_no, piece, start, length), one row per piece."""
    counted = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row_no"),
        length.cast("long").alias("tokens"),
    )
    last = F.expr(f"greatest((tokens - 1) div {longest}, 0)")
    start = F.col("piece") * longest
    return counted.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "doc_id",
        "row_no",
        "piece",
        start.alias("start"),
        F.least(F.col("tokens") - start, F.lit(longest)).cast("int").alias("length"),
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: Column | None = None,
    lengths: Sequence[int] = LENGTHS,
    part_tokens: int = PART_TOKENS,
) -> DataFrame:
    """(doc_id, row_no, piece, start, length, bin_id, bin_offset, bin_length) of every piece.

    ``length`` is the number of tokens of a document; by default its words.
    """
    spark = docs.sparkSession
    workers_see_package(spark)
    length = word_count(F.col(text_col)) if length is None else length
    cut = staged(pieces(docs, id_col, length, max(lengths)), "pieces")
    total = cut.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-total // part_tokens))
    part = F.pmod(F.xxhash64("doc_id", "row_no", "piece"), F.lit(parts))
    order = ["part", F.col("length").desc(), "doc_id", "row_no", "piece"]
    dealt = (
        cut.filter("length > 0")
        .withColumn("part", part)
        .repartition(max(parts, shuffle_partitions(spark)) if parts > 1 else 1, "part")
        .sortWithinPartitions(*order)
    )
    schema = "doc_id long, row_no long, piece long, start long, length int, bin_id long, bin_offset int, bin_length int"
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part_no, rows in _parts(batches):
            sizes = rows.column("length").to_numpy()
            placed, bins = best_packing(sizes.tolist(), lengths)
            final = bins[placed[:, 0]].astype(np.int32)
            more = [
                pa.array((part_no << 32) + placed[:, 0]),
                pa.array(placed[:, 1].astype(np.int32)),
                pa.array(final),
            ]
            out = pa.Table.from_arrays([rows.column(c) for c in names[:5]] + more, names=names)
            yield from out.combine_chunks().to_batches(max_chunksize=50_000)

    packed = dealt.mapInArrow(run, schema)
    empty = cut.filter("length = 0").selectExpr(
        *names[:5], "cast(null as long) bin_id", "cast(null as int) bin_offset", "cast(null as int) bin_length"
    )
    return packed.union(empty)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Runs of equal part in a sorted partition; a part has about ``part_tokens`` tokens."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = np.asarray(batch.column(batch.schema.get_field_index("part")))
        starts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(part)]
        for a, b in zip(starts, starts[1:], strict=False):
            if held and part[a] != last:
                yield int(last), pa.Table.from_batches(held)
                held = []
            last = part[a]
            held.append(batch.slice(int(a), int(b - a)))
    if held:
        yield int(last), pa.Table.from_batches(held)
