import numpy as np
import pytest

from txnmill.llm.topk import CoverTree, _members, dual_search, top_k


def brute(rows, queries, k, scale=256):
    import math

    clean = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        clean.setdefault((i, tuple(math.floor(scale * x) for x in v)))
    out = []
    for q in sorted({i for i, _ in clean if i in queries}):
        best = {}
        for i, v in clean:
            if i != q:
                continue
            for j, w in clean:
                if j != q and len(v) == len(w):
                    score = sum(a * b for a, b in zip(v, w, strict=True))
                    score = max(-(2**63), min(2**63 - 1, score))
                    best[j] = max(best.get(j, score), score)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n + 1, j, s) for n, (j, s) in enumerate(ranked)]
    return out


def run(spark, rows, queries, k=5, **options):
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, cell string, v string")
    asked = frame.filter(frame.vec_id.isin(list(queries)))
    return sorted(tuple(r) for r in top_k(frame, asked, k, **options).collect())


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + 0.1 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # one vector very often
    return rows


def test_trees_cover_and_search_is_exact(clustered):
    points = np.floor(256 * np.array([v for _, v in clustered], float))
    ids = np.array([i for i, _ in clustered])
    tree = CoverTree(points)
    for node, rows in enumerate(_members(tree)):
        assert np.sqrt(((points[rows] - tree.center[node]) ** 2).sum(1)).max() <= tree.radius[node] + 1e-9
    best = dual_search(points, ids, np.full(len(ids), -np.inf), points, ids, 5)
    scores = points @ points.T
    np.fill_diagonal(scores, -np.inf)
    order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :5]
    assert (best.ids == ids[order]).all()


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 20, "query_rows": 7, "pivots": 4}])
def test_equal_to_brute_force(spark, clustered, sizes):
    queries = {i for i, _ in clustered if i % 25 == 0}
    assert run(spark, clustered, queries, **sizes) == brute(clustered, queries, 5)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, []),
            (7, [0.5]), (8, [-0.5, 3.0]), (8, [-0.5, 3.0]), (8, [9.0, 9.0]), (None, [1.0, 1.0]), (9, [1e30, -1e30]),
            (10, [1e30, 1e30]), (11, [0.0, 0.0]), (50, [1.0, 2.0])]
    ids = {i for i, _ in rows if i is not None}
    assert run(spark, rows, ids, k=3) == brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], ids, 3)
    assert run(spark, [(1, [1.0])], {1}) == []
    assert run(spark, rows[:0], {1}) == []
