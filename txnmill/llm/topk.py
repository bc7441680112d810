"""Exact top-k by inner product with cover trees on both sides.

Vectors are dealt to cells by the nearest of a bounded number of pivots, and large cells to
blocks. In a block a cover tree is built over the candidates and one over the queries. Pairs of
nodes are searched together: no product between the members of two nodes exceeds

    c1 c2 + |c1| r2 + |c2| r1 + r1 r2

for centres ``c`` and covering radii ``r``, so a pair is pruned when that is below the worst
k-th score that any query of the node has so far.

The same bound first prunes cells: every query searches its own cell, and with the k-th score found
there it is sent only to cells that may hold something better. Scores of all blocks meet in one
aggregation per query, at most ``k`` a block. Queries of a block are dealt in chunks of
``query_rows``, so a task holds two bounded sets, whatever one cell's share of the rows is.

Defined cases: vectors that are null or hold a null or non-finite component take no part. Only
vectors of one length are compared. Equal rows count once. Rows with a null id are no queries and
no candidates. Rows with one id are the query's own, whatever their vectors; a query id with several
vectors keeps the best score of each candidate. Ties go to the smaller id. Scores beyond
64 bits stop at its ends. Other columns are ignored.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnmill.llm.common import shuffle_partitions, staged, workers_see_package

LEAF = 24
SHRINK = 0.75  # radius of a child's cover in its parent's
PIVOTS, PIVOT_SAMPLE = 64, 4096
BLOCK_ROWS, QUERY_ROWS = 4096, 2048
SLACK = 1e-9  # relative room for rounding in bounds
_EXACT = 2.0**53


class CoverTree:
    """Cover tree over the rows of ``points``; every node knows its true covering radius.

    A node's rows are covered by greedily chosen centres, the node's own first, with a radius
    ``SHRINK`` times its own. Equal rows end in one leaf.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.center: list[np.ndarray] = []
        self.norm: list[float] = []
        self.radius: list[float] = []
        self.rows: list[np.ndarray | None] = []
        self.children: list[list[int]] = []
        self.root = self._build(np.arange(len(points)), 0, None)

    def _node(self, rows: np.ndarray, center: int, far: float, leaf: bool) -> int:
        self.center.append(self.points[center])
        self.norm.append(float(np.sqrt((self.points[center] ** 2).sum())))
        self.radius.append(far * (1 + SLACK))
        self.rows.append(rows if leaf else None)
        self.children.append([])
        return len(self.radius) - 1

    def _build(self, rows: np.ndarray, center: int, away: np.ndarray | None) -> int:
        top = None
        work = [(rows, int(rows[0]) if away is None else center, away, None)]
        while work:
            rows, center, away, parent = work.pop()
            if away is None:
                away = self._distances(rows, center)
            far = float(away.max())
            leaf = len(rows) <= LEAF or far == 0
            node = self._node(rows, center, far, leaf)
            if parent is None:
                top = node
            else:
                self.children[parent].append(node)
            if leaf:
                continue
            left, cover = rows, far * SHRINK
            reach = away
            while len(left):
                inside = reach <= cover
                work.append((left[inside], center, reach[inside], node))
                left = left[~inside]
                if len(left):
                    # the row farthest from the last centre keeps centres apart
                    center = int(left[np.argmax(reach[~inside])])
                    reach = self._distances(left, center)
        return top

    def _distances(self, rows: np.ndarray, center: int) -> np.ndarray:
        apart = self.points[rows] - self.points[center]
        return np.sqrt(np.einsum("ij,ij->i", apart, apart))


class Best:
    """The k best (score, smaller id) of each query, and how low the worst of them is."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.floor = floor

    def worst(self, rows: np.ndarray) -> float:
        return float(np.maximum(self.scores[rows, -1], self.floor[rows]).min())

    def offer(self, rows: np.ndarray, own: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (queries, candidates); a candidate with the query's own id does not count."""
        k = self.scores.shape[1]
        scores = np.where(own[:, None] == ids[None], -np.inf, scores)
        useful = (scores >= self.scores[rows, -1:]).any(axis=1)
        if not useful.any():
            return
        rows, scores = rows[useful], scores[useful]
        scores = np.hstack([self.scores[rows], scores])
        names = np.hstack([self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))])
        names = np.where(np.isneginf(scores), np.iinfo(np.int64).max, names)
        order = np.lexsort((names, -scores), axis=1)[:, :k]
        self.scores[rows] = np.take_along_axis(scores, order, 1)
        self.ids[rows] = np.take_along_axis(names, order, 1)


def dual_search(
    queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int
) -> Best:
    """k best of ``points`` for each query that reach its ``floor``; both sides in cover trees."""
    best = Best(len(queries), k, floor)
    if not len(queries) or not len(points):
        return best
    asked, held = CoverTree(queries), CoverTree(points)
    centers = np.array(held.center)
    norms, radii = np.array(held.norm), np.array(held.radius)
    members = _members(asked)

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        r = asked.radius[q]
        bound = centers[nodes] @ asked.center[q] + asked.norm[q] * radii[nodes] + r * (norms[nodes] + radii[nodes])
        return bound + SLACK * (1 + np.abs(bound))

    work = [(asked.root, np.array([held.root]))]
    while work:
        q, nodes = work.pop()
        if asked.rows[q] is None:  # split both sides of the surviving pairs
            nodes = nodes[bounds(q, nodes) >= best.worst(members[q])]
            if not len(nodes):
                continue
            finer = [x for n in nodes.tolist() for x in (held.children[n] or [n])]
            work += [(child, np.array(finer)) for child in asked.children[q]]
        else:
            _finish(q, nodes, asked, held, bounds, best, members, queries, query_ids, points, ids)
    return best


def _members(tree: CoverTree) -> list[np.ndarray]:
    rows = list(tree.rows)
    for n in reversed(range(len(rows))):
        if rows[n] is None:
            rows[n] = np.concatenate([rows[c] for c in tree.children[n]])
    return rows


def _finish(q, nodes, asked, held, bounds, best, members, queries, query_ids, points, ids) -> None:
    """A leaf of queries against the nodes left to it, most promising first."""
    rows = members[q]
    heap = [(-b, n) for b, n in zip(bounds(q, nodes).tolist(), nodes.tolist(), strict=True)]
    heapq.heapify(heap)
    while heap:
        taken = []
        while heap and len(taken) < 256:  # leaves of about one bound are scored together
            bound, n = heapq.heappop(heap)
            if -bound < best.worst(rows):
                heap = []
                break
            if held.rows[n] is not None:
                taken.append(held.rows[n])
                if sum(map(len, taken)) >= 512:
                    break
            else:
                inner = np.array(held.children[n])
                for b, c in zip(bounds(q, inner).tolist(), inner.tolist(), strict=True):
                    heapq.heappush(heap, (-b, c))
        if taken:
            at = np.concatenate(taken)
            best.offer(rows, query_ids[rows], queries[rows] @ points[at].T, ids[at])


# Over a table


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(vec_id, v array<double>) with whole-number components; unusable rows are left out."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.transform(v, lambda x: _floor(x * scale))
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(usable, whole).alias("v"))
        .dropna()
        .distinct()
    )


def _floor(x):
    """floor that stays a double, so that huge components do not overflow."""
    small = F.abs(x) < 2.0**62
    return F.when(small, F.floor(F.when(small, x)).cast("double")).otherwise(x)


class Cells:
    """Pivots of a bounded sample, and the cells of vectors nearest to them."""

    def __init__(self, pivots: list[np.ndarray]):
        self.pivots = pivots
        self.radius = np.zeros(len(pivots))
        self.of_length: dict[int, np.ndarray] = {}
        for length in {len(p) for p in pivots}:
            self.of_length[length] = np.array([i for i, p in enumerate(pivots) if len(p) == length])

    @classmethod
    def choose(cls, sample: list[list[float]], count: int) -> "Cells":
        """Greedy cover of the sample's vectors of each length: the farthest one next."""
        pivots: list[np.ndarray] = []
        for length in sorted({len(v) for v in sample}):
            points = np.unique(np.array([v for v in sample if len(v) == length]), axis=0)
            apart = np.full(len(points), np.inf)
            at = 0
            for _ in range(min(count, len(points))):
                pivots.append(points[at])
                apart = np.minimum(apart, np.sqrt(((points - points[at]) ** 2).sum(axis=1)))
                at = int(apart.argmax())
                if apart[at] == 0:
                    break
        return cls(pivots)

    def nearest(self, vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance) of each vector; cell -1 if no pivot has its length."""
        cell, away = np.full(len(vectors), -1, np.int32), np.zeros(len(vectors))
        lengths = np.array([len(v) for v in vectors])
        for length in np.unique(lengths):
            known = self.of_length.get(int(length))
            if known is None:
                continue
            at = np.flatnonzero(lengths == length)
            points = np.stack([vectors[i] for i in at])
            centers = np.stack([self.pivots[c] for c in known])
            apart = (points**2).sum(1)[:, None] + (centers**2).sum(1) - 2 * points @ centers.T
            near = apart.argmin(axis=1)
            cell[at] = known[near]
            away[at] = np.sqrt(((points - centers[near]) ** 2).sum(axis=1)) * (1 + SLACK)
        return cell, away

    def worth(self, vector: np.ndarray, own: int, floor: float) -> list[int]:
        """Other cells that may hold a product of at least ``floor``."""
        cells = self.of_length.get(len(vector), np.empty(0, int))
        if not len(cells):
            return []
        centers = np.stack([self.pivots[c] for c in cells])
        bound = centers @ vector + np.sqrt((vector**2).sum()) * self.radius[cells]
        bound = bound + SLACK * (1 + np.abs(bound))
        return [int(c) for c in cells[bound >= floor] if c != own]


def top_k(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    pivots: int = PIVOTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query by the inner product
    of ``floor(scale * x)``. ``queries`` has rows of the same kind; by default all vectors ask."""
    spark = vectors.sparkSession
    workers_see_package(spark)
    clean = staged(quantized(vectors, id_col, vector_col, scale), "vectors")
    sample = clean.orderBy(F.xxhash64("vec_id", "v")).limit(PIVOT_SAMPLE).select("v").collect()
    cells = Cells.choose([r["v"] for r in sample], pivots)
    held = staged(_in_cells(clean, cells), "held")
    asked = held
    if queries is not None:
        asked = staged(_in_cells(quantized(queries, id_col, vector_col, scale), cells), "asked")
    # One row per cell, and there are no more cells than pivots.
    sizes = {r["cell"]: r for r in held.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("far")).collect()}
    for c, r in sizes.items():
        if c >= 0:
            cells.radius[c] = r["far"]
    blocks = {c: -(-r["n"] // block_rows) for c, r in sizes.items()}

    home = asked.select("vec_id", "v", "cell", F.lit(float("-inf")).alias("floor"))
    first = staged(_searched(home, held, blocks, k, query_rows), "first")
    kth = _best(first, k).filter(F.col("rank") == k).select("query_id", "query_hash", "score")
    kth = staged(kth, "kth")
    q = asked.select("vec_id", "v", "cell", F.xxhash64("v").alias("h"))
    bounded = q.join(kth, (q["vec_id"] == kth["query_id"]) & (q["h"] == kth["query_hash"]), "left")
    floor = F.coalesce(F.col("score").cast("double"), F.lit(float("-inf")))
    away = staged(_routed(bounded.select("vec_id", "v", "cell", floor.alias("floor")), cells), "routed")
    second = _searched(away, held, blocks, k, query_rows)
    # A query id with several vectors keeps each candidate once, with its best score.
    merged = first.union(second).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return _best(merged.withColumn("query_hash", F.lit(0).cast("long")), k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _in_cells(clean: DataFrame, cells: Cells) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            cell, away = cells.nearest([np.asarray(v) for v in rows["v"]])
            yield rows.assign(cell=cell, away=away)

    return clean.mapInPandas(run, "vec_id long, v array<double>, cell int, away double")


def _routed(bounded: DataFrame, cells: Cells) -> DataFrame:
    """Queries to the cells that may beat their k-th score; a row for each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            to = [
                cells.worth(np.asarray(v), c, f)
                for v, c, f in zip(rows["v"], rows["cell"], rows["floor"], strict=True)
            ]
            yield rows.assign(cell=to)

    schema = "vec_id long, v array<double>, cell array<int>, floor double"
    return bounded.mapInPandas(run, schema).withColumn("cell", F.explode("cell"))


def _searched(
    asked: DataFrame, held: DataFrame, blocks: dict[int, int], k: int, query_rows: int
) -> DataFrame:
    """(query_id, query_hash, vec_id, score): the k best of every block that a query was sent to."""
    spark = held.sparkSession
    counts = {r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect()}
    rows = [(c, n, -(-counts[c] // query_rows)) for c, n in blocks.items() if c in counts]
    plan = F.broadcast(spark.createDataFrame(rows, "cell int, blocks int, chunks int"))  # a row per cell
    hashed = F.xxhash64("vec_id", "v")
    left = (
        asked.join(plan, "cell")
        .withColumn("chunk", F.pmod(hashed, "chunks").cast("int"))
        .withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    )
    right = (
        held.join(plan, "cell")
        .withColumn("block", F.pmod(hashed, "blocks").cast("int"))
        .withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    )
    key = ["cell", "length", "block", "chunk"]
    left = left.select("cell", F.size("v").alias("length"), "block", "chunk", "vec_id", "v", "floor", F.xxhash64("v").alias("h"))
    right = right.select("cell", F.size("v").alias("length"), "block", "chunk", "vec_id", "v")
    n = shuffle_partitions(spark)
    pairs = left.repartition(n, *key).groupBy(*key).cogroup(right.repartition(n, *key).groupBy(*key))

    def run(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "query_hash", "vec_id", "score"]
        if ask.empty or have.empty:
            return pd.DataFrame({n: pd.Series([], dtype="int64") for n in names})
        queries = np.stack([np.asarray(v, float) for v in ask["v"]])
        points = np.stack([np.asarray(v, float) for v in have["v"]])
        ids, own = have["vec_id"].to_numpy(), ask["vec_id"].to_numpy()
        most = float(np.abs(queries).max(initial=0)) * float(np.abs(points).max(initial=0)) * queries.shape[1]
        if most >= _EXACT:
            found = _in_whole_numbers(queries, own, points, ids, k)
        else:
            best = dual_search(queries, own, ask["floor"].to_numpy(), points, ids, k)
            q, place = np.nonzero(~np.isneginf(best.scores))
            found = [q, best.ids[q, place], best.scores[q, place].astype(np.int64)]
        h = ask["h"].to_numpy()
        return pd.DataFrame(dict(zip(names, [own[found[0]], h[found[0]], found[1], found[2]], strict=True)))

    return pairs.applyInPandas(run, "query_id long, query_hash long, vec_id long, score long")


def _in_whole_numbers(queries, own, points, ids, k) -> list[np.ndarray]:
    """Blocks with products that doubles cannot hold exactly."""
    whole = [[int(x) for x in p] for p in points]
    top = 2**63 - 1
    out: list[tuple[int, int, int]] = []
    for i, vector in enumerate(queries):
        asked = [int(x) for x in vector]
        scores = [
            (-max(-top - 1, min(top, sum(a * b for a, b in zip(asked, p, strict=True)))), int(c))
            for p, c in zip(whole, ids, strict=True)
            if c != own[i]
        ]
        out += [(i, c, -s) for s, c in heapq.nsmallest(k, scores)]
    return [np.array(x, np.int64) for x in zip(*out, strict=True)] or [np.empty(0, np.int64)] * 3
