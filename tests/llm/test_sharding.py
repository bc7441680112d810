import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from txnmill.llm.sharding import kd_shards


def check(rows, got, shards):
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(0 <= s < shards for s in slots)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def loads(got, shards):
    out = [0] * shards
    for r in got:
        out[r.shard] += r["size"]
    return out


def test_equal_bytes_and_whole_groups(documents):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc \n") for _ in range(int(rng.expovariate(0.01)))) for _ in range(1500)]
    rows = [(i, texts[i % 1200]) for i in range(1500)]
    for shards in (16, 5):
        got = kd_shards(documents(*rows), shards=shards).collect()
        check(rows, got, shards)
        load = loads(got, shards)
        assert max(load) - min(load) <= 0.03 * sum(load) / shards + 2 * max(map(len, texts))
    groups = defaultdict(set)
    for r in got:
        groups[r.text_crc32].add(r.shard)
    assert sum(len(g) > 1 for g in groups.values()) <= 4


def places(text):
    """The metadata of a text, computed anew."""
    raw = (text or "").encode()
    return math.log2(len(raw) + 1), math.log2((text or "").count("\n") + 1), float(zlib.crc32(raw))


def check_tree(rows, shard_of, first, leaves, ranges, slack):
    """Every node lies on both sides of a weighted median of its widest dimension; returns the nodes seen."""
    if leaves == 1 or not rows:
        return 0
    left = [r for r in rows if shard_of[r[0]] < first + leaves // 2]
    right = [r for r in rows if shard_of[r[0]] >= first + leaves // 2]
    widths = [
        (max(r[2][d] for r in rows) - min(r[2][d] for r in rows)) / ranges[d] if ranges[d] else 0.0 for d in range(3)
    ]
    widest = [d for d in range(3) if widths[d] >= max(widths) * (1 - 1e-9)]
    if left and right and max(widths) > 0:
        assert any(max(r[2][d] for r in left) <= min(r[2][d] for r in right) + ranges[d] * 2**-35 for d in widest)
    weight = sum(r[1] for r in rows)
    largest = max(r[1] for r in rows)
    assert abs(sum(r[1] for r in left) - weight * (leaves // 2) / leaves) <= slack + largest
    half = leaves // 2
    return 1 + sum(
        check_tree(part, shard_of, at, n, ranges, slack)
        for part, at, n in ((left, first, half), (right, first + half, leaves - half))
    )


@pytest.mark.parametrize("shards, seed", [(16, 1), (7, 2), (2, 4)])
def test_every_node_is_cut_as_by_sorting(documents, shards, seed):
    """All nodes of the tree against medians found by sorting whole rows."""
    rng = random.Random(seed)
    texts = {"".join(rng.choice("ab \n" if rng.random() < 0.5 else "xyz") for _ in range(int(rng.expovariate(0.01)))) for _ in range(900)}
    rows = [(i, len(t.encode()) + 1, places(t)) for i, t in enumerate(sorted(texts))]
    got = kd_shards(documents(*enumerate(sorted(texts))), shards=shards).collect()
    ranges = [max(r[2][d] for r in rows) - min(r[2][d] for r in rows) for d in range(3)]
    slack = 0.002 * sum(r[1] for r in rows) / shards
    assert check_tree(rows, {r.doc_id: r.shard for r in got}, 0, shards, ranges, slack) == shards - 1


@pytest.mark.parametrize("rows", [1, 5])
def test_more_shards_than_texts(documents, rows):
    got = kd_shards(documents(*((i, "t" * (i % 3)) for i in range(rows))), shards=20).collect()
    check([(i, "t" * (i % 3)) for i in range(rows)], got, 20)


def test_a_hot_group_is_cut(documents):
    rows = [(i, "the same text again") for i in range(2000)] + [(5000 + i, f"text {i}" * (i % 7)) for i in range(1000)]
    got = kd_shards(documents(*rows), shards=8).collect()
    check(rows, got, 8)
    load = loads(got, 8)
    assert max(load) <= 1.05 * sum(load) / 8 and min(load) >= 0.95 * sum(load) / 8


def test_same_rows_same_shards(documents):
    rows = [(i, "x" * (i % 50)) for i in range(300)]
    first, second = (sorted(map(tuple, kd_shards(documents(*r)).collect())) for r in (rows, rows[::-1]))
    assert first == second


def test_odd_rows(odd, none):
    got = kd_shards(odd).collect()
    check([(r.doc_id, r.text) for r in odd.collect()], got, 16)
    assert kd_shards(none).count() == 0


def test_no_python_in_the_plan(odd):
    plan = kd_shards(odd)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
