"""SimHash fingerprints, linked by bit-sliced comparison, and near-duplicate groups.

A fingerprint has a bit set where more than half of the document's shingle hashes have it
set. Fingerprints are compared in blocks. A block stores its fingerprints as bit planes:
plane ``b`` holds bit ``b`` of 64 fingerprints per machine word. The distances of one
fingerprint to all others of the block grow plane by plane in carry-save counters, which are
planes too, and the block is abandoned as soon as every counter exceeds the radius.

Blocks come from keys; two fingerprints are compared if they share one.

* ``chunk_keys`` cuts the fingerprint into ``radius + 2`` chunks and takes all pairs of
  chunks. ``radius`` differing bits spoil at most ``radius`` chunks, so two fingerprints within
  the radius share a pair. Nothing is lost.
* ``anchor_keys`` takes bands of smallest shingle hashes. Documents of similarity 0.8 share
  one of 12 bands of three with probability 0.9998; wide radii need it, because chunks get
  too short there. A pair that shares several bands is compared in the first of them only.

A block of any size is worked on whole: one above ``block_rows`` is cut into sub-blocks by
hash, and each pair of sub-blocks is a group of its own. A group returns a minimum spanning
forest of the links it sees, at most one row per fingerprint, and never all pairs. Equal
fingerprints are one node, however many documents have them.

Defined cases: a null or empty text, or one of white space, has the fingerprint zero. Rows
with equal ids are separate documents. A null id takes no part in a group's smallest id; a
group of null ids only has a null one. Other columns are ignored.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmill.llm.common import shuffle_partitions, staged, workers_see_package
from txnmill.llm.components import components

SEED = 42
BLOCK_ROWS = 2048
BANDS, BAND_ROWS = 12, 3
PLANES_PER_LOOK = 8  # planes added between two looks at whether a block may be abandoned
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# Fingerprints


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, repeats included; fewer words make one run."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(run, SEED) for run in runs), np.uint64, len(words) - width + 1)


def remix(hashes: np.ndarray, turn: int) -> np.ndarray:
    """The ``turn``-th 64-bit word derived from each hash; turn 0 is the hash."""
    if turn == 0:
        return hashes
    with np.errstate(over="ignore"):
        z = hashes + np.uint64(turn) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(hashes: np.ndarray, bits: int) -> bytes:
    """Majority of each bit, the highest bit of the first word first."""
    n, out = len(hashes), b""
    for turn in range(bits // 64):
        votes = np.zeros(64, np.int64)
        for start in range(0, n, 8192):
            part = remix(hashes[start : start + 8192], turn).astype(">u8").view(np.uint8)
            votes += np.unpackbits(part.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out += np.packbits(2 * votes > n).tobytes()
    return out


def anchor_keys(hashes: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """One 32-bit key per band, of the smallest hashes under ``rows`` reorderings each."""
    if not len(hashes):
        return np.zeros(bands, np.uint32)
    least = [[int(remix(hashes, 1000 + band * rows + i).min()) for i in range(rows)] for band in range(bands)]
    return np.array([xxhash.xxh32_intdigest(repr(x)) for x in least], np.uint32)


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    bits: int = 64,
) -> DataFrame:
    """(doc_id, fp binary), one row per document; whole texts, no shuffle."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_fingerprints(narrow, "text", "fp", shingle_words, bits).select("doc_id", "fp")


def with_fingerprints(docs: DataFrame, text_col: str, name: str, shingle_words: int, bits: int = 64) -> DataFrame:
    """``docs`` with the fingerprints of their texts as a last column ``name``; no shuffle."""
    workers_see_package(docs.sparkSession)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            fps = [fingerprint(shingle_hashes(t.as_py(), shingle_words), bits) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.binary())], names=schema.names)

    return docs.mapInArrow(run, schema)


# Blocks


def chunk_keys(bits: int, radius: int) -> list[tuple[int, int]]:
    """Byte-free description of the chunks: first bit and width of each, ``radius + 2`` in all."""
    edges = np.linspace(0, bits, radius + 3).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(edges, edges[1:], strict=False)]


def _with_chunk_keys(nodes: DataFrame, bits: int, radius: int) -> DataFrame:
    """(key long, fp): one row per node and pair of chunks."""
    if bits != 64:
        raise ValueError("chunk keys are for 64-bit fingerprints")
    number = F.conv(F.hex("fp"), 16, -10).cast("long")

    def chunk(first: int, width: int):
        return F.shiftrightunsigned(F.shiftleft(number, first), 64 - width)

    pairs = [
        F.xxhash64(F.lit(i), chunk(*a), chunk(*b))
        for i, (a, b) in enumerate(combinations(chunk_keys(bits, radius), 2))
    ]
    return nodes.select(F.explode(F.array(*pairs)).alias("key"), "fp")


def shared_keys(keyed: DataFrame) -> DataFrame:
    """(key, members) of keys that several rows have; counted before the shuffle."""
    counts = keyed.groupBy("key").agg(F.count("*").alias("members"))
    return staged(counts.filter("members > 1"), "sizes")


def link_forest(
    keyed: DataFrame, sizes: DataFrame, radius: int, bits: int, bands: int = 0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Links (a, b: as ``fp`` in ``keyed``) within ``radius``, a spanning forest of every block.

    ``keyed`` has (key long, fp binary), each pair once; ``sizes`` is its ``shared_keys``. A key with
    more than ``block_rows`` members is split: members are dealt to sub-blocks by hash and every pair
    of sub-blocks is a group. With ``bands`` a ``fp`` is the fingerprint, a name and its anchor
    keys, and ``keyed`` has the ``band`` of the key.
    """
    spark = keyed.sparkSession
    workers_see_package(spark)
    parts = F.ceil(F.col("members") / block_rows).cast("int")
    dealt = (
        keyed.join(sizes, "key")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("fp", "key"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "key",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            (F.col("own") <= F.col("other")).alias("left"),
            (F.col("band") if bands else F.lit(0)).cast("int").alias("band"),
            "fp",
        )
    )
    order = ["key", "low", "high"]
    grouped = dealt.repartition(4 * shuffle_partitions(spark), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for low, high, left, band, rows in _groups(batches):
            keys = rows[:, -4 * bands :].copy().view(np.uint32)[:, :band] if bands else None
            pairs = _forest(rows[:, : bits // 8].copy(), left if low != high else None, radius, keys)
            if len(pairs):
                a, b = (np.ascontiguousarray(rows[pairs[:, i]]) for i in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes() for x in side], pa.binary()) for side in (a, b)],
                    names=["a", "b"],
                )

    return grouped.mapInArrow(run, "a binary, b binary").distinct()


def _groups(batches):
    """Runs of equal (key, low, high) over the batches of a sorted partition; a run is bounded by
    two sub-blocks, so it fits in memory."""
    last, parts = None, []

    def out():
        left = np.concatenate([p[0] for p in parts])
        return last[1], last[2], left, last[3], np.concatenate([p[1] for p in parts])

    for batch in batches:
        if not batch.num_rows:
            continue
        key, low, high, left, band, fps = batch.columns
        ids = np.stack([np.asarray(c).astype(np.int64) for c in (key, low, high, band)], axis=1)
        left = np.asarray(left.cast(pa.int8())).astype(bool)
        raw = np.frombuffer(b"".join(fps.to_pylist()), np.uint8).reshape(len(ids), -1)
        starts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1), len(ids)]
        for a, b in zip(starts, starts[1:], strict=False):
            now = tuple(int(x) for x in ids[a])
            if parts and now != last:
                yield out()
                parts = []
            last = now
            parts.append((left[a:b], raw[a:b]))
    if parts:
        yield out()


# Comparison


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(bits, words): row ``b`` has bit ``b`` of all fingerprints, 64 in a word."""
    bits = np.unpackbits(fps, axis=1).T
    pad = -bits.shape[1] % 64
    bits = np.pad(bits, ((0, 0), (0, pad)))
    return np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little")).view(np.uint64)


def distances(queries: np.ndarray, planes: np.ndarray, members: int, radius: int) -> np.ndarray:
    """Distances (queries, members) as uint16; ``radius + 1`` stands for all above the radius.

    ``counters[j]`` holds bit ``j`` of all distances. Adding a plane is a ripple of bitwise
    half adders; a carry out of the last counter sets ``over`` for good.
    """
    words = planes.shape[1]
    width = max(1, int(radius).bit_length())
    ask = np.unpackbits(queries, axis=1).astype(bool)
    counters = np.zeros((width, len(queries), words), np.uint64)
    over = np.zeros((len(queries), words), np.uint64)
    alive = np.arange(len(queries))
    result = np.full((len(queries), members), radius + 1, np.uint16)
    for b in range(len(planes)):
        add = np.where(ask[alive, b][:, None], ~planes[b], planes[b])
        for counter in counters:
            carry = counter & add
            np.bitwise_xor(counter, add, out=counter)
            add = carry
        over |= add
        if b % PLANES_PER_LOOK == PLANES_PER_LOOK - 1:
            beyond = over | _above(counters, radius)
            keep = (beyond != _FULL).any(axis=1)
            if not keep.all():  # blocks whose members all are too far are given up
                alive, over, counters = alive[keep], over[keep], counters[:, keep]
                if not len(alive):
                    return result
    beyond = _bits(over | _above(counters, radius), members)
    found = np.zeros((len(alive), members), np.uint16)
    for j, counter in enumerate(counters):
        found |= _bits(counter, members).astype(np.uint16) << np.uint16(j)
    found[beyond.astype(bool)] = radius + 1
    result[alive] = found
    return result


def _above(counters: np.ndarray, radius: int) -> np.ndarray:
    """Where the number in the counters exceeds the radius, as bits."""
    above = np.zeros_like(counters[0])
    equal = np.full_like(counters[0], _FULL)
    for j in reversed(range(len(counters))):
        if radius >> j & 1:
            equal &= counters[j]
        else:
            above |= equal & counters[j]
            equal &= ~counters[j]
    return above


def _bits(words: np.ndarray, members: int) -> np.ndarray:
    raw = np.ascontiguousarray(words).view(np.uint8)
    return np.unpackbits(raw, axis=1, bitorder="little")[:, :members]


def _forest(
    fps: np.ndarray, left: np.ndarray | None, radius: int, seen: np.ndarray | None = None
) -> np.ndarray:
    """Minimum spanning forest of the links among ``fps``, or between its left and right rows.

    Pairs that agree in a column of ``seen`` were compared elsewhere and are left out.
    """
    if left is None and len(fps) <= 4:
        return _few(fps, radius, seen)
    rows, columns = (None, None) if left is None else (np.flatnonzero(left), np.flatnonzero(~left))
    own, other = (fps, fps) if left is None else (fps[rows], fps[columns])
    if not len(own) or not len(other):
        return np.empty((0, 2), np.int64)
    planes = bit_planes(other)
    step = max(16, 2**21 // (planes.shape[1] * 8))
    grid = np.concatenate(
        [distances(own[i : i + step], planes, len(other), radius) for i in range(0, len(own), step)]
    )
    if seen is not None:
        a, b = (seen, seen) if left is None else (seen[rows], seen[columns])
        for band in range(seen.shape[1]):
            grid[a[:, band, None] == b[None, :, band]] = radius + 1
    if left is None:
        np.fill_diagonal(grid, radius + 1)
    linked = np.flatnonzero((grid <= radius).any(axis=1))
    if not len(linked):
        return np.empty((0, 2), np.int64)
    return _prim(grid, rows, columns, len(fps), radius)


def _few(fps: np.ndarray, radius: int, seen: np.ndarray | None) -> np.ndarray:
    """All links of a handful of rows, for which planes of 64 would be all but empty."""
    pairs = np.array(list(combinations(range(len(fps)), 2)), np.int64).reshape(-1, 2)
    apart = np.unpackbits(fps[pairs[:, 0]] ^ fps[pairs[:, 1]], axis=1).sum(axis=1)
    near = apart <= radius
    if seen is not None:
        near &= ~(seen[pairs[:, 0]] == seen[pairs[:, 1]]).any(axis=1)
    return pairs[near]


def _prim(grid, rows, columns, nodes: int, radius: int) -> np.ndarray:
    far = radius + 1
    place = np.full(nodes, -1)
    if rows is not None:
        place[rows], place[columns] = np.arange(len(rows)), np.arange(len(columns))
    is_row = np.ones(nodes, bool) if rows is None else np.isin(np.arange(nodes), rows)
    best = np.full(nodes, far, np.int64)
    source = np.full(nodes, -1)
    todo = np.ones(nodes, bool)
    found = []
    for _ in range(nodes):
        now = int(np.argmin(np.where(todo, best, far + 1)))
        todo[now] = False
        if best[now] <= radius:
            found.append((source[now], now))
        if rows is None:
            reach, at = grid[now], slice(None)
        elif is_row[now]:
            reach, at = grid[place[now]], columns
        else:
            reach, at = grid[:, place[now]], rows
        nearer = reach < best[at]
        if nearer.any():
            near = np.flatnonzero(nearer) if rows is None else at[nearer]
            best[near] = reach[nearer]
            source[near] = now
    return np.array(found, np.int64).reshape(-1, 2)


# Groups


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    radius: int = 2,
) -> DataFrame:
    """(doc_id, fp binary, component_id): documents whose 64-bit fingerprints are chained by links
    of at most ``radius`` bits share the smallest id among them. Exact, see ``chunk_keys``."""
    marked = staged(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    nodes = staged(nodes, "nodes")
    return marked.join(least_ids(nodes, linked(nodes.select("fp"), radius)), "fp", "left").select(
        "doc_id", "fp", "component_id"
    )


def linked(nodes: DataFrame, radius: int) -> DataFrame:
    """(node, root) of the distinct 64-bit fingerprints ``fp`` that have a link; chained ones share the root."""
    keyed = _with_chunk_keys(nodes, 64, radius)
    return components(link_forest(keyed, shared_keys(keyed), radius, 64))


def one_of_each_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    radius: int = 2,
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group of :func:`simhash_groups` the row with the
    smallest id, a null id being larger than any other. Of several rows with that id and fingerprint one stays.

    Documents are written once with their fingerprints, and shuffled once with what decides on them.
    """
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # columns may have any names
    doc_id = F.col(f"c{docs.columns.index(id_col)}").cast("long")
    text = f"c{docs.columns.index(text_col)}"
    marked = staged(with_fingerprints(own, text, "fp", shingle_words), "marked")
    rows = marked.groupBy(doc_id.alias("doc_id"), "fp").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "copies")).alias("first")
    nodes = staged(rows.groupBy("fp").agg(first), "nodes")
    roots = linked(nodes.select("fp"), radius).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = F.min(F.struct("first.n", "first.doc_id", "fp", "first.copies")).alias("least")
    kept = staged(rooted.groupBy("root").agg(least).select("least.doc_id", "least.fp", "least.copies"), "kept")

    single, several = (kept.filter(c).select("doc_id", F.col("fp").alias("its_fp")) for c in ("copies = 1", "copies > 1"))
    same = (F.col("fp") == F.col("its_fp")) & doc_id.eqNullSafe(F.col("doc_id"))
    # what is joined with texts grows with them, so this join is the same at every size
    unique = marked.join(single.hint("merge"), same, "left_semi")
    if not several.isEmpty():
        again = marked.join(several.hint("merge"), same, "left_semi")
        unique = unique.union(again.dropDuplicates(["fp", f"c{docs.columns.index(id_col)}"]))
    return unique.drop("fp").toDF(*docs.columns)


def least_ids(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(fp, component_id) from (fp, first_id) and (node, root); staged, so a join with the
    documents can split a fingerprint that a third of them have."""
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    rooted = staged(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return staged(rooted.join(staged(least, "least"), "root").select("fp", "component_id"), "classes")
