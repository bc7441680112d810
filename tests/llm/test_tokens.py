import random
import re
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txnmill.llm import elias_fano
from txnmill.llm.token_counts import PieceCounter, token_counts
from txnmill.llm.token_files import Encoder, Segment, _cut, read_token_files, segment_bytes, write_token_files
from txnmill.session import shared_dir

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
HARD = ["", " ", "   a  b   ", "\n\n\t x", "a <|endoftext|>b<|endoftext|>", "<s> hi </s>", "日本語テキスト 中文", "a" * 900,
        "ab" * 400, " " * 300, "😀😀 é́", "abc  x  ", "!!\x1c a\x1c", "it's we'll 'm don'ts", "▁▁a▁", "a1b2_c3", " naïve Ωmega",
        " abcδ abć x", "\x00\x01 a", "\r\n\r\n a"]


def noise(seed, n):
    rng = random.Random(seed)
    letters = " abcdefghij  klmnop\n\t\r.,!'s0123\x1c éßñ日😀▁"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(n)]


@given(st.lists(st.integers(0, 10**6), max_size=600))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values):
    values = sorted(values)
    code = elias_fano.Sequence(elias_fano.encode(np.array(values, np.int64)))
    assert code.all().tolist() == values
    assert [code[i] for i in range(len(code))] == values
    assert code.select(np.arange(len(values))).tolist() == values


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(100, 900, 10_000))
    assert 8 * len(elias_fano.encode(ends)) < 13 * len(ends)


@pytest.mark.parametrize("steps", [[0], [1], [10**9], [0, 0, 0, 10**6], [2**40, 0, 3], [1] * 50 + [10**5]])
def test_select_equals_all(steps):
    """Long gaps, many equal numbers, wide low bits; in any order and repeated."""
    rng = np.random.default_rng(len(steps))
    values = np.cumsum(rng.choice(steps, 3000))
    code = elias_fano.Sequence(elias_fano.encode(values))
    numbers = rng.integers(0, len(values), 5000)
    assert (code.all() == values).all()
    assert (code.select(numbers) == values[numbers]).all()
    assert code.select(np.empty(0, int)).tolist() == []
    for outside in (-1, len(values)):
        with pytest.raises(IndexError):
            code.select(np.array([outside]))


def test_segments_round_trip():
    documents = [np.arange(n, dtype=np.uint32) for n in (1, 0, 5, 1000)]
    for width in (2, 4):
        segment = Segment(segment_bytes(np.concatenate(documents), np.array([len(d) for d in documents]), width))
        starts, ends = segment.bounds(1, 4)
        assert (starts.tolist(), ends.tolist()) == ([1, 1, 6], [1, 6, 1006])
        assert [segment.document(i).tolist() for i in range(len(segment))] == [d.tolist() for d in documents]
    with pytest.raises(ValueError):
        Segment(b"NONE" + bytes(20))


@pytest.fixture(scope="module")
def encoder():
    return Encoder(BYTES)


def test_words_give_the_library_ids(encoder):
    texts = HARD + noise(1, 400)
    want = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.by_runs
    assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_texts_are_cut_as_by_the_pattern():
    """Each text's runs, and one more behind it; code points of every width, also such as stand behind texts."""
    words = re.compile("( [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)(?!\\w)")
    odd = [" a\0 b\0", "\0", " a", "a", " é٣ é", " ×a ÷ ɏ ɐ", " a_ a\u0301", "\ud7ff\ue000 x😀 y"]
    for texts in (HARD + odd, noise(6, 300), [""], odd[:1] * 3):
        runs, last = _cut(texts)
        ends = {int(i) for i in last}
        want = [[*filter(None, words.split(text))] for text in texts]
        assert [run for i, run in enumerate(runs.to_pylist()) if i not in ends] == sum(want, [])
        assert np.diff(last, prepend=-1).tolist() == [len(part) + 1 for part in want]


def test_blocks_with_and_without_end_ids(encoder):
    texts = ["", "a\0", "\0\0 b", "", " c é 😀"]
    for end in (0, 7, None, 0):
        (ids, sizes), = encoder.blocks(texts, end)
        want = [[*encoder.library.encode(t, add_special_tokens=False).ids, *([] if end is None else [end])] for t in texts]
        assert (ids.tolist(), sizes.tolist()) == (sum(want, []), [len(part) for part in want])


def test_forgotten_words_are_learned_again(monkeypatch):
    monkeypatch.setattr("txnmill.llm.token_files.CACHED_RUNS", 50)
    monkeypatch.setattr("txnmill.llm.token_files.RUNS_AT_ONCE", 40)
    encoder = Encoder(BYTES)
    texts = noise(2, 100) + ["the same words again and again"] * 30 + noise(3, 50)
    want = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_other_models_get_whole_texts():
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Some words, lower case.", "", "x  y"]
    want = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert not encoder.by_runs
    assert [ids.tolist() for ids in encoder.encode(texts)] == want


def check_files(spark, docs, encoder, **options):
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    write_token_files(docs, path, BYTES, **options)
    rows = docs.select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in read_token_files(path, spark).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))
    want = []
    for r in rows:
        ids = [*encoder.library.encode(r.text or "", add_special_tokens=False).ids, 0]
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((i is not None, i or 0, n, c) for i, _, n, c in got) == sorted((i is not None, i or 0, n, c) for i, n, c in want)
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n


def test_files_of_documents(spark, documents, encoder):
    rows = list(enumerate(HARD + noise(4, 100)))
    random.Random(1).shuffle(rows)
    for segment_ids in (1_000_000, 50):
        check_files(spark, documents(*rows), encoder, segment_ids=segment_ids)


def test_files_of_odd_rows(spark, odd, none, encoder):
    check_files(spark, odd, encoder)
    check_files(spark, none, encoder)


@pytest.fixture(scope="module")
def counter():
    return PieceCounter(PIECES)


def test_counts_are_the_library_ones(counter):
    rng = random.Random(7)
    runs = ["".join(rng.choice("etaoin") for _ in range(rng.randint(200, 600))) for _ in range(10)]
    texts = HARD + noise(5, 400) + runs + ["the" * 200, "x" * 3000]
    assert counter.counts(texts).tolist() == [len(x) for x in counter.library.encode(texts)]


def test_long_sequences_by_heap_and_by_arrays(counter):
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoinsh") for _ in range(n)) for n in range(2, 200)]
    symbols = [counter.of_char[[ord(c) for c in w]].tolist() for w in words]
    assert [counter._by_heap(s) for s in symbols] == counter.word_counts(words).tolist()


def test_count_query(odd, none, counter):
    rows = token_counts(odd, PIECES, limit=3).collect()
    texts = [r.text or "" for r in odd.collect()]
    assert len(rows) == len(texts)
    want = sorted((len(t.encode()), n, n > 3) for t, n in zip(texts, map(len, counter.library.encode(texts)), strict=True))
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert token_counts(none, PIECES).count() == 0
