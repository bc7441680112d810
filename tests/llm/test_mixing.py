import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from txnmill.llm.mixing import BLOCK_WORDS, mixed_documents, mixture, sainte_lague


def plain_sainte_lague(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(votes, key=lambda u: (Fraction(votes[u]) / (2 * won[u] + 1), -u))
        won[best] += 1
    return won


def test_quotas_are_the_highest_quotients(spark):
    rng = random.Random(1)
    rows = []
    for group in range(6):
        for unit in range(rng.randint(1, 12)):
            rows.append((group, unit, float(rng.choice([0, 1, 3, 3, 50, 977, 10**6])), [0, 1, 5, 40, 333, 2][group]))
    frame = spark.createDataFrame(rows, "g int, u int, votes double, seats long")
    got = {(r.g, r.u): r.quota for r in sainte_lague(frame, "g", "u", "votes", "seats").collect()}
    for group in range(6):
        votes = {u: v for g, u, v, _ in rows if g == group}
        want = plain_sainte_lague(votes, rows[[r[0] for r in rows].index(group)][3])
        if sum(votes.values()):
            assert {u: got[group, u] for u in votes} == want


def plain_targets(sizes, weights, cap):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = sum(weight[s] for s in open_)
        target = {s: cap * sizes[s] if s in capped else left * weight[s] / share for s in names}
        over = {s for s in open_ if target[s] > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        capped |= over


def sample_rows(rng, sources, n):
    return [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 60))), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("block_words", [1, BLOCK_WORDS])
@pytest.mark.parametrize("shard_words", [10**6, 300])
def test_mix_meets_targets(documents, shard_words, block_words):
    rng = random.Random(2)
    rows = sample_rows(rng, ["a"] * 30 + ["B", "ä", None, "c", "c", "日"], 500)
    mix = mixture(documents(*rows), shard_words=shard_words, block_words=block_words).collect()
    source = {i: s for i, _, s in rows}
    sizes = Counter()
    for i, text, s in rows:
        sizes[s] += len(text.split())
    want = plain_targets(sizes, (1, 2, 3), 3)
    taken = Counter()
    assert len(mix) == len(rows)
    for r in mix:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r["size"]
        assert r.taken == r.passes * r["size"] + sum(x["to"] - x["from"] for x in r.spans or [])
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * block_words + 1e-6 * want[s]


def test_every_block_but_those_cut_by_a_document_is_whole(documents):
    """The unit that is dealt does not follow the size of the corpus."""
    rows = [(i, " ".join(["w"] * 64), "ab"[i % 2]) for i in range(40)]
    for n in (10, 40):
        for r in mixture(documents(*rows[:n])).collect():
            assert all((x["to"] - x["from"]) % BLOCK_WORDS == 0 for x in r.spans or [])


def test_reruns_agree(documents):
    docs = documents(*sample_rows(random.Random(3), ["a", "b", "c"], 80))
    first, second = (sorted(map(str, mixture(docs).collect())) for _ in range(2))
    assert first == second
    moved = mixture(docs.orderBy(F.desc("doc_id")).repartition(7))
    assert sorted(map(str, moved.collect())) == first


def test_documents_of_the_mix_have_the_words(documents):
    docs = documents(*sample_rows(random.Random(5), ["a"] * 9 + ["b", "c"], 120))
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    text = {r.doc_id: r.text for r in docs.collect()}
    words = defaultdict(int)
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
        assert set(r.text.split()) <= set(text[r.doc_id].split())
    want = {r.doc_id: r.taken for r in mixture(docs).collect() if r.taken}
    assert dict(words) == want


def test_odd_rows(odd, none):
    mix = mixture(odd).collect()
    assert len(mix) == odd.count()
    assert {r.taken for r in mix if r["size"] == 0} == {0}
    total = sum(r["size"] for r in mix)
    assert total - BLOCK_WORDS < sum(r.taken for r in mix) <= total
    out = mixed_documents(odd)
    assert sum(len(r.text.split()) for r in out.collect()) == sum(r.taken for r in mix)
    assert mixture(none).count() == 0 and mixed_documents(none).count() == 0
