import random
import zlib

import pytest

from txnmill.llm.periodic_runs import periodic_runs, runs_of
from txnmill.llm.queries import _with_planted_runs


def brute(words, least_words=6, least_repeats=4):
    """Every maximal stretch of every period; of the periods of a stretch the smallest counts."""
    smallest = {}
    for q in range(1, len(words) // least_repeats + 1):
        i = q
        while i < len(words):
            begin = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - begin + q >= max(least_words, least_repeats * q):
                smallest.setdefault((begin - q, i - begin + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in smallest.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng, most):
    words = []
    letters = [c.encode() for c in "abcde"[: rng.choice([1, 2, 2, 3, 5])]]
    while rng.random() < 0.85:
        words += [rng.choice(letters) for _ in range(rng.randint(1, 9))] * rng.randint(1, 7)
    return words[:most]


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_to_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(400):
        documents = [repetitive(rng, 150) for _ in range(rng.randint(1, 4))]
        for least_words, least_repeats in ((6, 4), (1, 4), (9, 5)):
            runs, starts = runs_of(documents, least_words, least_repeats)
            want = [
                (s + int(starts[d]), n, q)
                for d, words in enumerate(documents)
                for s, n, q in brute(words, least_words, least_repeats)
            ]
            assert [tuple(r) for r in runs.tolist()] == want


def test_frequent_words_stay_linear():
    runs, _ = runs_of([[b"w"] * 200_000, [b"a", b"b", b"c"] * 50_000])
    assert runs.tolist() == [[0, 200_000, 1], [200_000, 150_000, 3]]


def test_fewer_repeats_are_refused(odd):
    with pytest.raises(ValueError):
        periodic_runs(odd, least_repeats=3)


def test_odd_rows(odd, none):
    rows = periodic_runs(odd).collect()
    given = odd.select("doc_id", "text").collect()
    want = []
    for i, text in given:
        words = (text or "").encode().split()
        runs = brute(words)
        want.append((i, runs, collapsed(words, runs).decode()))
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(runs for _, runs, _ in got)
    assert periodic_runs(none).collect() == []


def test_chunks_do_not_change_runs(documents, monkeypatch):
    rng = random.Random(9)
    texts = [b" ".join(repetitive(rng, 300)).decode() for _ in range(60)]
    frame = documents(*enumerate(texts))
    whole = sorted(map(str, periodic_runs(frame).collect()))
    monkeypatch.setattr("txnmill.llm.periodic_runs.CHUNK_WORDS", 40)
    assert sorted(map(str, periodic_runs(frame).collect())) == whole


def test_planted_runs(documents):
    rng = random.Random(2)
    texts = {i: " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))) for i in range(300)}
    frame = documents(*texts.items(), (None, "x y"), (300, None))
    got = {i: text for i, text in _with_planted_runs(frame).collect()}
    changed = 0
    for i, text in texts.items():
        h, words = zlib.crc32(str(i).encode()), text.split()
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
            changed += 1
        assert (got[i] or "").split() == words
    assert changed > 10 and got[None] == "x y" and not got[300]
