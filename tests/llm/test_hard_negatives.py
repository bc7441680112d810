import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnmill.llm.hard_negatives import Bucket, Pack, _focus, feasible, hard_negatives, percent_range

ENDS = -(2**63), 2**63 - 1
SCHEMA = "vec_id long, embedding array<float>, label int, v string, dim string, score string, chunk string"


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    of_id = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(scale * float(np.float32(x))) for x in v])
        of_id[i] = min(of_id.get(i, row), row)
    out = []
    for a, (label, v) in of_id.items():
        if not is_anchor(a):
            continue
        scored = [
            (-min(max(sum(x * y for x, y in zip(v, w, strict=True)), ENDS[0]), ENDS[1]), i, other == label)
            for i, (other, w) in of_id.items()
            if i != a and len(w) == len(v)
        ]
        scored.sort()
        for cost, p, _ in [s for s in scored if s[2]][:positives]:
            hard = [(c, i) for c, i, same in scored if not same and low * -cost <= 100 * -c <= high * -cost]
            out += [(a, p, rank + 1, i, -cost, -c) for rank, (c, i) in enumerate(hard[:negatives])]
    return sorted(out)


def run(spark, rows, every=1, **options):
    frame = spark.createDataFrame([(*r, "v", "d", "s", "c") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hard_negatives(frame, F.col("vec_id") % every == 0, **options).collect())


@pytest.fixture(scope="module")
def clustered():
    """A third of the rows with one label, lengths that differ, one vector very often."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(5, 6))
    rows = []
    for i in range(500):
        v = (centers[i % 5] + 0.6 * rng.normal(size=6)) * rng.choice([0.1, 1.0, 4.0])
        rows.append((i, v.astype(np.float32).tolist(), 0 if i % 3 == 0 else i % 7))
    return rows + [(1000 + i, rows[0][1], i % 2) for i in range(50)]


SMALL = {"bucket_rows": 16, "slice_buckets": 2, "anchor_rows": 5}


@pytest.mark.parametrize("options", [{}, SMALL, SMALL | {"focus": 1}, {"positives": 2, "negatives": 3, "low": 0, "high": 100}])
def test_equal_to_brute_force(spark, clustered, options):
    some = {k: options[k] for k in ("positives", "negatives", "low", "high") if k in options}
    got = run(spark, clustered, every=20, **options)
    assert got == brute(clustered, lambda i: i % 20 == 0, **some)
    assert len(got) > 50


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [0.5, 1.0], 2), (3, None, 1), (4, [1.0, 1.0], None), (5, [nan, 1.0], 1),
            (6, [inf, 0.0], 2), (7, [1.0, None], 1), (None, [1.0, 2.0], 1), (8, [], 1), (9, [], 1), (10, [], 2), (11, [0.0, 0.0], 1),
            (12, [0.0, 0.0], 2), (13, [1.0], 1), (14, [0.5], 2), (15, [0.4, 1.0], 2), (15, [0.4, 1.0], 2), (15, [9.0, 9.0], 3),
            (16, [-1.0, -2.0], 1), (17, [1e30, 1e30], 1), (18, [1e30, 0.0], 2), (19, [1e30, -1e30], 2), (20, [2e15, 1.0], 1),
            (21, [1000.0, 0.0], 1), (22, [0.0390625, 0.0], 2)]
    want = brute(rows, lambda i: True)
    assert run(spark, rows) == want and run(spark, rows, **SMALL) == want
    assert any(positive_score == ENDS[1] for *_, positive_score, _ in want)
    assert run(spark, rows[:0]) == [] and run(spark, [(0, [1.0], 1)]) == [] and run(spark, rows[1:], every=101) == []


def _pack(kind, rows, labels=None):
    v = np.array(rows, float)
    ids = np.arange(len(v), dtype=np.int64)
    return kind({"ids": ids.tobytes(), "its_labels": ids.tobytes(), "v": v.tobytes(), "n": len(v), "dim": v.shape[1]})


def test_coordinates_prune_and_lose_nothing():
    rng = np.random.default_rng(1)

    def similar_lengths(n):
        v = rng.normal(size=(n, 8))
        return np.floor(256 * v / np.linalg.norm(v, axis=1, keepdims=True) * rng.uniform(0.95, 1, size=(n, 1)))

    anchors, bucket = _pack(Pack, similar_lengths(40)), _pack(Bucket, similar_lengths(300))
    exact = anchors.v @ bucket.v.T
    best = np.sort(exact, axis=1)
    shares = []
    for floor, cap in ((best[:, -2], np.inf), (best[:, -6], np.inf), (0.0, 1.0), (best[:, 0], best[:, 3])):
        floor, cap = np.broadcast_to(floor, 40), np.broadcast_to(cap, 40)
        candidates = feasible(anchors, _focus(anchors, 3), bucket, floor, cap)
        wanted = (exact >= floor[:, None]) & (exact <= cap[:, None])
        assert not (wanted & ~candidates).any()
        shares.append(candidates.mean())
    assert shares[0] < shares[1] < 0.6


@pytest.mark.parametrize("score", [-7, 0, 1, 3, 10, 99, 2**62, -(2**63)])
def test_percent_range(score):
    low, high = percent_range(score, 30, 90)
    for s in range(low - 2, low + 3):
        assert (30 * score <= 100 * s) == (s >= low)
    for s in range(high - 2, high + 3):
        assert (100 * s <= 90 * score) == (s <= high)
