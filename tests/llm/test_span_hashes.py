import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnmill.llm.span_hashes import BASES, PRIMES, WINDOW, PrefixHash, Print, edited, fingerprints, likeness

letters = st.text(alphabet="ab😀é", max_size=40)


@given(letters, letters, st.data())
@settings(max_examples=150, deadline=None)
def test_spans_and_extensions(a, b, data):
    one, two = PrefixHash(a), PrefixHash(b)
    i, j = data.draw(st.integers(0, len(a))), data.draw(st.integers(0, len(b)))
    n = data.draw(st.integers(0, min(len(a) - i, len(b) - j)))
    assert one.equal(i, two, j, n) == (a[i : i + n] == b[j : j + n])
    length = one.extension(i, two, j)
    assert a[i : i + length] == b[j : j + length]
    assert i + length == len(a) or j + length == len(b) or a[i + length] != b[j + length]
    assert (one.fingerprint == two.fingerprint) == (a == b)


def words(rng, n):
    text = ""
    while len(text) < n:
        text += " " + "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    return text[:n]


def plain_spans(text, level):
    """Texts between the places whose window, hashed alone, is below the level's limit."""
    cuts = []
    for i in range(1, len(text) - WINDOW + 1):
        h = sum((ord(c) + 1) * pow(BASES[0], k, PRIMES[0]) for k, c in enumerate(text[i : i + WINDOW])) % PRIMES[0]
        mixed = (h * 0x9E3779B97F4A7C15 % 2**64 >> 20) % 2**32
        if mixed < 2 ** (32 - level):
            cuts.append(i)
    ends = [0, *cuts, len(text)]
    return [text[i:j] for i, j in zip(ends, ends[1:], strict=False)]


def plain_likeness(one, other):
    """The longest common runs of spans, compared as texts."""
    if one == other:
        return 1.0
    level = max(max(2, (len(t) // 64).bit_length()) for t in (one, other))
    a, b = plain_spans(one, level), plain_spans(other, level)
    used, common, i = set(), 0, 0
    while i < len(a):
        j = next((j for j in range(len(b)) if j not in used and b[j] == a[i]), None)
        if j is None:
            i += 1
            continue
        run = 0
        while i + run < len(a) and j + run < len(b) and j + run not in used and a[i + run] == b[j + run]:
            run += 1
        used.update(range(j, j + run))
        common += sum(map(len, a[i : i + run]))
        i += run
    return min(2 * common / (len(one) + len(other)), 1 - 1 / (len(one) + len(other) + 1))


def prints(*texts):
    return [str(PrefixHash(t).print()) for t in texts]


def changes(rng, text):
    n = len(text)
    return {
        "ends": "x" + text[1:-1] + "y", "longer": "x" + text + "y", "middle": text[: n // 2] + "#" + text[n // 2 + 1 :],
        "half": text[: n - n // 2] + words(rng, n // 2), "turned": text[n // 2 :] + text[: n // 2], "double": text + words(rng, n),
        "part": text[n // 4 : 3 * n // 4], "twice": text + text, "other": words(rng, n),
    }


@pytest.mark.parametrize("n", [0, 1, 5, 6, 7, 40, 300, 900])
def test_likeness_equals_that_of_the_texts_of_the_spans(n):
    rng = random.Random(n)
    for _ in range(6):
        text = words(rng, n)
        for name, other in changes(rng, text).items():
            got = likeness(*prints(text, other))
            assert got == pytest.approx(plain_likeness(text, other)), name
            assert got == pytest.approx(likeness(*prints(other, text)), abs=0.2)
            assert (got == 1) == (text == other)


def test_an_edit_costs_what_it_touches():
    seen = {}
    for seed in range(20):
        rng = random.Random(seed)
        text = words(rng, 5000)
        for name, other in changes(rng, text).items():
            seen.setdefault(name, []).append(likeness(*prints(text, other)))
    mean = {name: sum(all_) / len(all_) for name, all_ in seen.items()}
    assert min(mean[name] for name in ("ends", "longer", "middle")) > 0.93
    assert min(map(min, (seen[name] for name in ("ends", "longer", "middle")))) > 0.8
    assert 0.4 < mean["half"] < 0.55 and mean["turned"] > 0.85 and 0.55 < mean["double"] < 0.7
    assert max(seen["other"]) < 0.05


def test_fingerprints_are_bounded():
    rng = random.Random(1)
    for text in (words(rng, 200_000), "ab" * 50_000, "a" * 10_000, words(rng, 60) * 2000, "é" * 7):
        fingerprint = prints(text)[0]
        assert len(fingerprint) < 4000 and Print.parse(fingerprint).n == len(text)
        assert str(Print.parse(fingerprint)) == fingerprint
        assert sum(n for _, n, _ in Print.parse(fingerprint).spans) == len(text)


def check(docs):
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    want = []
    for r, following in zip(rows, rows[1:] + rows[:1], strict=True):
        new = edited(r.t, following.t)
        own, changed, after = prints(r.t, new, following.t)
        sha = hashlib.sha256(new.encode()).hexdigest()
        want.append((r.doc_id, len(r.t), sha, own, changed, likeness(own, changed), likeness(own, after)))
    got = fingerprints(docs).collect()

    def key(x):
        return (x[0] is not None, x[0] or 0, *x[1:])

    assert sorted(map(key, got)) == sorted(map(key, want))
    return got


def test_documents(documents):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc é😀\n") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    rows = [(rng.randint(-(10**6), 10**6), t) for t in texts]
    got = check(documents(*{i: (i, t) for i, t in rows}.values()))
    by_print = {}
    for r in got:
        by_print.setdefault(r.fingerprint, r)
    assert len({r.fingerprint for r in got}) == len({t for t in dict(rows).values()})


def test_odd_rows(odd, none, documents):
    check(odd)
    check(documents((5, "alone in the table")))
    check(documents((None, "a"), (None, "b"), (None, None)))
    assert fingerprints(none).count() == 0
