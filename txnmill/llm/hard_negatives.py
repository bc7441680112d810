"""Hard negatives by inner product: coordinate pruning in buckets of vectors of similar length.

For every anchor its ``positives`` best other rows of the same label are found, and for each of these the
``negatives`` best rows of other labels whose score lies between ``low`` and ``high`` percent of the positive's.

Rows are sorted by label and length and packed into buckets. A bucket holds, for every coordinate, its rows in
order of their value there, taken from vectors of length one. An anchor that needs a score of at least ``floor``
skips a bucket whose longest row is too short for that. Else the cosine has to be at least
``floor / (|anchor| * longest)``, and at most ``cap / (|anchor| * shortest)`` where scores have an upper end: both
bound the angle, and so the values that a candidate can have in any one coordinate. For the anchor's focus
coordinates, its largest ones, a binary search in the sorted lists gives the rows in that range; what is in all of
them is scored exactly. The floor of an anchor rises with the worst of the scores that it has.

Anchors are packed too. A tile is one pack of anchors and the buckets of one slice, and pairs that cannot have a
result, by length or label, are no tile. So a task holds bounded sets, whatever share of the rows one label has, and
gives at most the wanted number of rows for an anchor or pair; those of all tiles meet in one ranking.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no part. Of several
rows of one id the one with the smallest label, then vector, counts. Only vectors with the same number of
components are compared. Scores beyond 64 bits stop at its ends. A positive of negative score has no range and
so no negatives. Ties go to the smaller id. Other columns are ignored, whatever their names.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnmill.llm.common import shuffle_partitions, staged, workers_see_package
from txnmill.llm.topk import _floor

BUCKET_ROWS, SLICE_BUCKETS, ANCHOR_ROWS = 256, 64, 256
FOCUS = 3
SLACK = 1e-9  # relative room for rounding in bounds
NO_ID = np.iinfo(np.int64).max
_EXACT = 2.0**53
_ENDS = -(2**63), 2**63 - 1
PACK = (
    "place long, slice long, dim int, n int, longest double, labels array<bigint>, "
    "ids binary, its_labels binary, v binary"
)


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """(vec_id, label, v, dim, norm): one row per id, with whole-number components; unusable rows are left out."""
    v = F.col(vector_col).cast("array<double>")
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.when(usable, F.transform(v, lambda x: _floor(x * scale))).alias("v"),
    ).dropna()
    single = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.*")
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    return single.select("*", F.size("v").alias("dim"), F.sqrt(squares).alias("norm"))


def packed(rows: DataFrame, pack_rows: int, slice_packs: int = 1) -> DataFrame:
    """Rows by label and falling length, ``pack_rows`` of them to a pack and ``slice_packs`` packs to a slice."""
    order = ["dim", "label", F.desc("norm"), "vec_id"]
    n = shuffle_partitions(rows.sparkSession)
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return ranged.select("vec_id", "label", "v", "dim", "norm").mapInArrow(
        partial(_packs, pack_rows=pack_rows, slice_packs=slice_packs), PACK
    )


def _packs(batches: Iterator[pa.RecordBatch], pack_rows: int, slice_packs: int) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    made = 0
    ids, labels, norms, values = ([] for _ in range(4))
    dim = -1

    def flushed() -> Iterator[pa.RecordBatch]:
        nonlocal made
        if ids:
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "place": first + made,
                        "slice": first + made // slice_packs,
                        "dim": dim,
                        "n": len(ids),
                        "longest": max(norms),
                        "labels": sorted(set(labels)),
                        "ids": np.array(ids, np.int64).tobytes(),
                        "its_labels": np.array(labels, np.int64).tobytes(),
                        "v": np.concatenate(values).astype(float).tobytes(),
                    }
                ],
                schema=_PACK_ARROW,
            )
            made += 1
        for held in (ids, labels, norms, values):
            held.clear()

    for batch in batches:
        columns = [batch.column(i) for i in (0, 1, 3, 4)]
        vectors = batch.column(2)
        for i, (vec_id, label, size, norm) in enumerate(zip(*(c.to_pylist() for c in columns), strict=True)):
            if size != dim or len(ids) == pack_rows:
                yield from flushed()
            if size != dim:
                dim, made = size, -(-made // slice_packs) * slice_packs  # a slice has vectors of one size
            ids.append(vec_id)
            labels.append(label)
            norms.append(norm)
            values.append(vectors[i].values.to_numpy(zero_copy_only=False))
    yield from flushed()


_PACK_ARROW = pa.schema(
    [("place", pa.int64()), ("slice", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("longest", pa.float64()),
     ("labels", pa.list_(pa.int64())), ("ids", pa.binary()), ("its_labels", pa.binary()), ("v", pa.binary())]
)


class Pack:
    """Rows of a pack and their lengths."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["its_labels"], np.int64)
        self.v = np.frombuffer(row["v"], float).reshape(row["n"], row["dim"])
        self.norms = np.sqrt((self.v**2).sum(axis=1))
        with np.errstate(invalid="ignore", divide="ignore"):
            self.unit = np.where(self.norms[:, None] > 0, self.v / self.norms[:, None], 0.0)
        self.largest = float(np.abs(self.v).max(initial=0.0))


class Bucket(Pack):
    """A pack with its rows in order of every coordinate."""

    def __init__(self, row: dict):
        super().__init__(row)
        self.longest, self.shortest = float(self.norms.max()), float(self.norms.min())
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def in_order(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted values of the coordinate, and each row's place among them."""
        if coordinate not in self._sorted:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            self._sorted[coordinate] = self.unit[order, coordinate], place
        return self._sorted[coordinate]


def feasible(
    anchors: Pack, focus: np.ndarray, bucket: Bucket, floor: np.ndarray, cap: np.ndarray
) -> np.ndarray:
    """Which rows of the bucket (columns) may score between floor and cap with which anchors (rows)."""
    reach = anchors.norms * bucket.longest * (1 + SLACK)
    finite = np.where(np.isinf(floor), 0, floor)
    may = reach >= floor - SLACK * np.abs(finite)
    candidates = np.repeat(may[:, None], len(bucket.ids), axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        least = np.where(floor > 0, np.clip(floor / reach, -1, 1), -1.0)
        beyond = anchors.norms * bucket.shortest
        most = np.where((cap >= 0) & (beyond > 0), np.clip(cap / beyond, -1, 1), 1.0)
    widest = np.arccos(np.nan_to_num(least, nan=-1.0))  # angle to a candidate at most, and at least
    narrowest = np.arccos(np.nan_to_num(most, nan=1.0))
    for slot in focus.T:
        own = np.arccos(np.clip(anchors.unit[np.arange(len(slot)), slot], -1, 1))  # angle to the axis
        below = np.cos(np.minimum(np.pi, own + widest)) - SLACK
        above = np.cos(np.maximum(0.0, np.maximum(own - widest, narrowest - own))) + SLACK
        for coordinate in np.unique(slot[may]):
            mine = np.flatnonzero(may & (slot == coordinate))
            values, place = bucket.in_order(int(coordinate))
            first = np.searchsorted(values, below[mine], "left")
            end = np.searchsorted(values, above[mine], "right")
            candidates[mine] &= (place >= first[:, None]) & (place < end[:, None])
    return candidates


def scores(anchors: Pack, bucket: Bucket, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Exact inner products; whole numbers where doubles are not."""
    if anchors.largest * bucket.largest * anchors.v.shape[1] < _EXACT:
        return (anchors.v[rows] @ bucket.v[columns].T).astype(np.int64)
    whole = [[[int(x) for x in v] for v in side] for side in (anchors.v[rows], bucket.v[columns])]
    exact = [[min(max(sum(map(int.__mul__, a, b)), _ENDS[0]), _ENDS[1]) for b in whole[1]] for a in whole[0]]
    return np.array(exact, np.int64).reshape(len(rows), len(columns))


class Kept:
    """The k best (score, smaller id) of each of some lists."""

    def __init__(self, lists: int, k: int):
        self.cost = np.full((lists, k), NO_ID)  # ~score, which falls as the score rises
        self.ids = np.full((lists, k), NO_ID)

    def worst(self) -> np.ndarray:
        """Score that a candidate needs to be kept."""
        return np.where(self.ids[:, -1] == NO_ID, -np.inf, (~self.cost[:, -1]).astype(float))

    def offer(self, lists: np.ndarray, score: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> None:
        """Scores by list and candidate, as far as wanted."""
        wanted = wanted & (~score <= self.cost[lists, -1:])
        some = wanted.any(axis=1)
        lists, score, wanted = lists[some], score[some], wanted[some]
        if not len(lists):
            return
        cost = np.hstack([self.cost[lists], np.where(wanted, ~score, NO_ID)])
        names = np.hstack([self.ids[lists], np.where(wanted, ids[None], NO_ID)])
        order = np.lexsort((names, cost), axis=1)[:, : self.ids.shape[1]]
        self.cost[lists] = np.take_along_axis(cost, order, 1)
        self.ids[lists] = np.take_along_axis(names, order, 1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists, place = np.nonzero(self.ids != NO_ID)
        return lists, self.ids[lists, place], ~self.cost[lists, place]


def _focus(anchors: Pack, focus: int) -> np.ndarray:
    """The largest coordinates of every anchor."""
    return np.argsort(-np.abs(anchors.unit), axis=1, kind="stable")[:, :focus]


def _searched(
    anchors: Pack, buckets: Iterator[Bucket], owner: np.ndarray, low: np.ndarray, high: np.ndarray,
    same_label: bool, k: int, focus: int,
) -> Kept:
    """The k best of the buckets for each of some lists: list ``i`` belongs to anchor ``owner[i]`` and takes scores
    from ``low[i]`` to ``high[i]``."""
    kept = Kept(len(owner), k)
    at = _focus(anchors, focus)
    lowest = low.astype(float)
    highest = np.where(high == _ENDS[1], np.inf, high.astype(float))  # what stops there may be more
    cap = np.full(len(anchors.ids), -np.inf)
    np.maximum.at(cap, owner, highest)
    asked = np.bincount(owner, minlength=len(anchors.ids)) > 0
    for bucket in buckets:
        floor = np.full(len(anchors.ids), np.inf)
        np.minimum.at(floor, owner, np.maximum(lowest, kept.worst()))
        possible = feasible(anchors, at, bucket, floor, cap) & asked[:, None]
        possible &= (anchors.labels[:, None] == bucket.labels) == same_label
        possible &= anchors.ids[:, None] != bucket.ids
        rows, columns = np.flatnonzero(possible.any(axis=1)), np.flatnonzero(possible.any(axis=0))
        if not len(rows):
            continue
        exact = scores(anchors, bucket, rows, columns)
        place = np.full(len(anchors.ids), -1)
        place[rows] = np.arange(len(rows))
        lists = np.flatnonzero(place[owner] >= 0)
        mine = exact[place[owner[lists]]]
        wanted = possible[owner[lists]][:, columns] & (mine >= low[lists, None]) & (mine <= high[lists, None])
        kept.offer(lists, mine, bucket.ids[columns], wanted)
    return kept


def _headers(packs: DataFrame, by: str) -> DataFrame:
    """(by, dim, longest, label) of packs, a row for each label they hold."""
    each = packs.select(by, "dim", "longest", F.explode("labels").alias("label"))
    return each.groupBy(by, "dim", "label").agg(F.max("longest").alias("longest"))


def _salted(small: DataFrame, large: DataFrame, on: list[str], salts: int) -> DataFrame:
    """Join of headers that spreads one frequent key over ``salts`` groups."""
    left = small.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)))
    right = large.withColumn("salt", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")))
    return left.join(right, [*on, "salt"])


def _tiles(pairs: DataFrame, chunks: DataFrame, buckets: DataFrame) -> DataFrame:
    """Packs of every tile of ``pairs``: its anchors, with what they are to find, and its buckets."""
    names = ["chunk", "slice", "kind", "place", "dim", "n", "longest", "ids", "its_labels", "v", "pairs"]
    left = pairs.join(chunks.drop("slice"), "chunk").withColumns({"kind": F.lit(0), "place": F.lit(0).cast("long")})
    right = pairs.join(buckets, "slice").withColumns({"kind": F.lit(1), "pairs": F.lit(None).cast(_PAIRS)})
    return left.select(names).unionByName(right.select(names))


_PAIRS = "array<struct<anchor_id: bigint, positive_id: bigint, score: bigint>>"


def _of_tile(table: pa.Table) -> tuple[int, Pack, list[dict], Iterator[Bucket]]:
    rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], -r["longest"], r["place"]))
    return rows[0]["chunk"], Pack(rows[0]), rows[0]["pairs"], map(Bucket, rows[1:])


def _positives(table: pa.Table, k: int, focus: int) -> pa.Table:
    chunk, anchors, _, buckets = _of_tile(table)
    all_of_them = np.arange(len(anchors.ids))
    low, high = (np.full(len(anchors.ids), end, np.int64) for end in _ENDS)
    kept = _searched(anchors, buckets, all_of_them, low, high, True, k, focus)
    owner, ids, score = kept.found()
    return pa.table({"chunk": np.full(len(ids), chunk), "anchor_id": anchors.ids[owner], "vec_id": ids, "score": score})


def percent_range(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores ``s`` with ``low * score <= 100 * s <= high * score``."""
    return -((-low * score) // 100), (high * score) // 100


def _negatives(table: pa.Table, k: int, focus: int, low: int, high: int) -> pa.Table:
    _, anchors, pairs, buckets = _of_tile(table)
    at = {int(i): row for row, i in enumerate(anchors.ids)}
    ranges = [percent_range(p["score"], low, high) for p in pairs]
    asked = [(p, *ends) for p, ends in zip(pairs, ranges, strict=True) if ends[0] <= ends[1]]
    owner = np.array([at[p["anchor_id"]] for p, _, _ in asked], np.int64)
    lows, highs = (np.array([a[i] for a in asked], np.int64) for i in (1, 2))
    kept = _searched(anchors, buckets, owner, lows, highs, False, k, focus)
    lists, ids, score = kept.found()
    of_pair = lambda name: np.array([p[name] for p, _, _ in asked], np.int64)[lists]
    return pa.table(
        {
            "anchor_id": of_pair("anchor_id"),
            "positive_id": of_pair("positive_id"),
            "vec_id": ids,
            "positive_score": of_pair("score"),
            "score": score,
        }
    )


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    focus: int = FOCUS,
    bucket_rows: int = BUCKET_ROWS,
    slice_buckets: int = SLICE_BUCKETS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). ``is_anchor`` chooses rows by
    the columns ``vec_id`` and ``label``; scores are inner products of ``floor(scale * x)``."""
    spark = vectors.sparkSession
    workers_see_package(spark)
    n = shuffle_partitions(spark)
    rows = staged(prepared(vectors, id_col, vector_col, label_col, scale), "vectors")
    buckets = staged(packed(rows, bucket_rows, slice_buckets), "buckets")
    no_pairs = F.lit(None).cast(_PAIRS)
    chunks = staged(
        packed(rows.filter(is_anchor), anchor_rows).withColumn("chunk", F.col("place")).withColumn("pairs", no_pairs),
        "anchors",
    )
    slices = staged(_headers(buckets, "slice"), "slices")

    def positives_of(tile: pa.Table) -> pa.Table:
        return _positives(tile, positives, focus)

    def negatives_of(tile: pa.Table) -> pa.Table:
        return _negatives(tile, negatives, focus, low, high)

    meet = _salted(_headers(chunks, "chunk").drop("longest"), slices, ["dim", "label"], n)
    tiles = _tiles(meet.select("chunk", "slice").distinct(), chunks, buckets)
    near = tiles.repartition(n, "chunk", "slice").groupBy("chunk", "slice").applyInArrow(
        positives_of, "chunk long, anchor_id long, vec_id long, score long"
    )
    best = staged(_ranked(near, ["anchor_id"], positives), "positives")

    its_pairs = F.struct("anchor_id", F.col("vec_id").alias("positive_id"), "score")
    asking = chunks.drop("pairs").join(
        best.groupBy("chunk").agg(F.collect_list(its_pairs).alias("pairs"), F.min("score").alias("least")), "chunk"
    )
    asking = staged(asking, "asking")
    # A slice of other vectors that are too short, or of the anchors' only label, is left out.
    per_slice = slices.groupBy("slice", "dim").agg(
        F.max("longest").alias("reach"), F.min("label").alias("least_label"), F.max("label").alias("greatest_label")
    )
    per_chunk = asking.select("chunk", "dim", "longest", F.array_min("labels").alias("from"), F.array_max("labels").alias("to"), "least")
    alone = "least_label = greatest_label AND `from` = `to` AND `from` = least_label"
    too_short = F.col("longest") * F.col("reach") * (1 + SLACK) < F.col("least") * (low / 100) * (1 - SLACK)
    meet = _salted(per_chunk, per_slice, ["dim"], n).filter(f"NOT ({alone})").filter(~too_short | (F.col("least") <= 0))
    tiles = _tiles(meet.select("chunk", "slice"), asking, buckets)
    hard = tiles.repartition(n, "chunk", "slice").groupBy("chunk", "slice").applyInArrow(
        negatives_of,
        "anchor_id long, positive_id long, vec_id long, positive_score long, score long",
    )
    return _ranked(hard, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )

