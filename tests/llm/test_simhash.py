import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from txnmill.llm import simhash
from txnmill.llm.components import components
from txnmill.llm.simhash import one_of_each_group, simhash_groups


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, prints, radius):
    best = {i: i for i in range(len(rows))}

    def find(i):
        while best[i] != i:
            i = best[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                best[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = find(i)
            least[r] = min(least.get(r, doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(rows))]


def test_words_match_spark_hash(spark):
    texts = ["a b c", "é ü 日本", "one"]
    got = [r[0] % 2**64 for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]
    assert got == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


@pytest.mark.parametrize("radius", [0, 2, 5])
def test_planes_give_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 256, (6, 8)).astype(np.uint8)
    fps = base[rng.integers(0, 6, 150)]
    for i in range(len(fps)):
        for b in rng.integers(0, 64, rng.integers(0, 6)):
            fps[i, b // 8] ^= 1 << (b % 8)
    true = np.unpackbits(fps[:, None] ^ fps[None], axis=2).sum(2)
    got = simhash.distances(fps, simhash.bit_planes(fps), len(fps), radius)
    assert (got == np.where(true <= radius, true, radius + 1)).all()


def test_groups_equal_brute_force(spark, documents):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for i in range(300)]
    rows += [(400 + i, rows[i][1]) for i in range(60)]
    got = {r.doc_id: (int(r.fp.hex(), 16), r.component_id) for r in simhash_groups(documents(*rows)).collect()}
    prints = [plain_fingerprint(t) for _, t in rows]
    groups = plain_groups(rows, prints, 2)
    assert got == {i: (p, g) for (i, _), p, g in zip(rows, prints, groups, strict=True)}


def test_split_blocks_lose_no_link(spark):
    """A block far above the sub-block size, dealt to many groups."""
    rng = np.random.default_rng(9)
    prints = [int(x) for x in np.unique(rng.integers(0, 2**20, 400))]
    nodes = spark.createDataFrame([(bytearray(p.to_bytes(8, "big")),) for p in prints], "fp binary")
    keyed = simhash._with_chunk_keys(nodes, 64, 3)
    links = simhash.link_forest(keyed, simhash.shared_keys(keyed), 3, 64, block_rows=40)
    roots = {int(bytes(r.node).hex(), 16): bytes(r.root) for r in components(links).collect()}
    rows = [(p, None) for p in prints]
    want = plain_groups(rows, prints, 3)
    by_root, by_group = {}, {}
    for p, g in zip(prints, want, strict=True):
        by_root.setdefault(roots.get(p, p), set()).add(p)
        by_group.setdefault(g, set()).add(p)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_group.values()))


def test_odd_rows(odd, none):
    rows = simhash_groups(odd).collect()
    assert len(rows) == odd.count()
    zero = {r.doc_id: r.component_id for r in rows if int(r.fp.hex(), 16) == 0}
    assert zero == {0: 0, 1: 0, 2: 0, 3: 0, None: 0}
    assert simhash_groups(none).count() == 0


def test_components_of_a_long_chain_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (7, 7), (200, 200), (None, 3), (5, None)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(roots) == {*range(61), 100, 101, 102, 200}
    assert len({roots[i] for i in range(61)}) == 1
    assert len({roots[i] for i in (100, 101, 102)}) == 1
    assert roots[200] == 200 and roots[100] != roots[0]


def smallest_of_groups(rows, radius=2):
    """Smallest id of each row's group, by comparing all fingerprints."""
    prints = [plain_fingerprint(t) for _, t in rows]
    best = list(range(len(rows)))

    def find(i):
        while best[i] != i:
            i = best[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                best[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append((doc_id is None, doc_id or 0, i))
    return [min(g) for g in groups.values()]


def near_copies(rng):
    rows = []
    for base in range(30):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(60, 400))]
        rows.append((1000 - base, " ".join(words)))
        for copy in range(5):
            other = list(words)
            for _ in range(copy):
                other[rng.randrange(len(other))] = "new"
            rows.append((base * 10 + copy, "  ".join(other).upper()))
    return rows


def test_one_of_each_group_stays(documents):
    rows = near_copies(random.Random(8))
    kept = sorted(r.doc_id for r in one_of_each_group(documents(*rows)).collect())
    want = sorted(i for _, i, _ in smallest_of_groups(rows))
    assert kept == want and 30 <= len(want) < 150
    groups = {r.component_id for r in simhash_groups(documents(*rows)).collect()}
    assert groups == set(want)


def test_one_of_each_group_of_odd_rows(odd, none, documents):
    given = [(r.doc_id, r.text) for r in odd.collect()]
    kept = one_of_each_group(odd)
    assert kept.columns == odd.columns
    want = sorted((n, i) for n, i, _ in smallest_of_groups(given))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == want
    assert one_of_each_group(none).count() == 0


def test_rows_of_one_id_in_different_groups(documents):
    """Two texts under one id, a copy of one of them under a smaller id, and repeated rows."""
    rng = random.Random(4)
    a, b, c = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(50)) for x in "abc")
    rows = [(5, a), (5, b), (3, b), (7, c), (7, c), (7, c), (None, c.upper()), (None, "alone here"), (None, "alone here")]
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in one_of_each_group(documents(*rows)).collect())
    assert kept == [(False, 3, b), (False, 5, a), (False, 7, c), (True, 0, "alone here")]


def test_two_texts_of_one_id_in_one_group(documents):
    words = [f"w{i}" for i in range(300)]
    own = plain_fingerprint(" ".join(words))
    others = (" ".join([*words[:-1], f"x{i}"]) for i in range(1000))
    near = next(t for t in others if 1 <= (plain_fingerprint(t) ^ own).bit_count() <= 2)
    rows = [(1, " ".join(words)), (1, near), (2, " ".join(words))]
    assert len(smallest_of_groups(rows)) == 1
    kept = one_of_each_group(documents(*rows)).collect()
    assert [r.doc_id for r in kept] == [1]
