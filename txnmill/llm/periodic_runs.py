"""Periodic runs of words: stretches that repeat a block of words many times over.

A run is a stretch of consecutive words with smallest period ``q``, at least ``least_words`` and
``least_repeats * q`` words long, that no neighbouring word extends keeping the period.

Search is an online sparse dynamic program over diagonals. A diagonal is a lag ``q``; going through a
document word by word, an earlier occurrence of the word ``q`` places back adds one to the match length of
the lag, and a diagonal that gets no match ends: if it was long enough, its run is emitted at once. Only
active diagonals are kept.

Of the earlier occurrences of a word, few can belong to a run. One of lag ``2^k < q <= 2^(k+1)`` stands for
at least ``3 q > 3 * 2^k = g`` matches in a row, so not the word but the window of ``g`` words that starts
there has to recur, and only its nearest recurrence counts. Say a window recurs ``q`` back and, nearer,
``p`` back. Is ``p > 2^k``, it recurs ``q - p`` apart as well; else its periods ``p + q <= g``. Both ways, by
the theorem of Fine and Wilf, a divisor of ``p`` is a period of the window and of the words up to its nearest
recurrence, so it is ``p`` itself, it divides ``q``, and the whole stretch has period ``p``: ``q`` is not its
smallest. So a word has at most one match for each power of two, however often it stands in the text, the
work is ``n log n``, and lags that are no smallest period never become active.

Documents are dealt with where they lie, without a shuffle; a task holds the words of some documents at a
time, of ``CHUNK_WORDS`` words together or one longer document.

Defined cases: words are what ASCII white space leaves, compared by their bytes. A null text has no words and
gives no runs and an empty text. Null and repeated ids and repeated rows stay as they are, a result row for
each. Other columns are ignored, whatever their names.
"""

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.llm.common import workers_see_package

CHUNK_WORDS = 1 << 18
LEAST_WORDS, LEAST_REPEATS = 6, 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def window_words(lag: int) -> int:
    """Words of a window whose recurrence is looked for at this lag."""
    return 1 if lag == 1 else 3 << ((lag - 1).bit_length() - 1)


def _ranked(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key recurs, a dense number of the key, and how far back the key stood before (0: nowhere)."""
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    again = np.r_[False, same]
    number = np.cumsum(~again) - 1
    back = np.zeros(len(keys), np.int64)
    back[order[1:][same]] = np.diff(places[order])[same]
    ids = np.empty(len(keys), np.int64)
    ids[order] = number
    recurs = np.empty(len(keys), bool)
    recurs[order] = again | np.r_[same, False]
    return places[recurs], ids[recurs], back[recurs]


def recurrences(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the matches that can belong to a run, by place.

    ``words`` are numbers that differ between documents, so nothing recurs across two of them.
    """
    n = len(words)
    found = [(np.flatnonzero(np.diff(words) == 0) + 1, np.int64(1))]
    single = _ranked(words, np.arange(n))[:2]
    pair = _ranked(*_extended(*single, *single, 1))[:2]
    places, ids, back = _ranked(*_extended(*pair, *single, 2))
    lag = 2  # the largest of this scale
    while len(places):
        useful = (back > lag // 2) & (back <= lag)
        found.append((places[useful], back[useful]))
        places, ids, back = _ranked(*_extended(places, ids, places, ids, window_words(lag)))
        lag *= 2
    place = np.concatenate([p for p, _ in found])
    lags = np.concatenate([np.broadcast_to(q, p.shape) for p, q in found])
    order = np.lexsort((lags, place))
    return place[order], lags[order]


def _extended(
    places: np.ndarray, ids: np.ndarray, other_places: np.ndarray, other_ids: np.ndarray, ahead: int
) -> tuple[np.ndarray, np.ndarray]:
    """(key, place) of windows continued by those that start ``ahead`` words on, where there are such."""
    at = np.searchsorted(other_places, places + ahead)
    at[at == len(other_places)] = 0
    there = other_places[at] == places + ahead if len(other_places) else np.zeros(len(places), bool)
    most = int(other_ids.max(initial=0)) + 1
    return ids[there] * most + other_ids[at[there]], places[there]


def emitted(
    places: np.ndarray, lags: np.ndarray, least_words: int, least_repeats: int
) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of every run, each when its diagonal ends."""
    active: dict[int, int] = {}  # lag -> matches in a row so far

    def ended(lag: int, matches: int, last: int) -> Iterator[tuple[int, int, int]]:
        extra = window_words(lag) - 1  # the last window matches to its end
        length = matches + extra + lag
        if length >= max(least_words, least_repeats * lag):
            yield last + extra + 1 - length, length, lag

    now, here = -2, {}
    for place, lag in zip(places.tolist(), lags.tolist()):
        if place != now:
            for q, matches in active.items():
                yield from ended(q, matches, now - 1)
            if place != now + 1:
                for q, matches in here.items():
                    yield from ended(q, matches, now)
                here = {}
            active, here, now = here, {}, place
        here[lag] = active.pop(lag, 0) + 1
    for q, matches in active.items():
        yield from ended(q, matches, now - 1)
    for q, matches in here.items():
        yield from ended(q, matches, now)


def runs_of(
    documents: list[list[bytes]], least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS
) -> tuple[np.ndarray, np.ndarray]:
    """Runs of some documents, (start, length, period) by document, start and period, with starts
    counted through all documents, and where each document starts."""
    sizes = np.array([len(words) for words in documents], np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    known = {word: i for i, word in enumerate({word for words in documents for word in words})}
    ids = np.fromiter((known[word] for words in documents for word in words), np.int64, int(starts[-1]))
    ids += np.repeat(np.arange(len(documents)) * len(known), sizes)
    runs = sorted(emitted(*recurrences(ids), least_words, least_repeats), key=lambda r: (r[0], r[2]))
    return np.array(runs, np.int64).reshape(-1, 3), starts


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[list[bytes]]]]:
    for batch in batches:
        first, held, size = 0, [], 0
        for i in range(batch.num_rows):
            words = (batch.column(1)[i].as_py() or b"").split()
            held.append(words)
            size += len(words)
            if size >= CHUNK_WORDS:
                yield batch.column(0).slice(first, len(held)), held
                first, held, size = i + 1, [], 0
        if held:
            yield batch.column(0).slice(first, len(held)), held


def _collapsed(documents: list[list[bytes]], runs: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """Texts without the words that a run has after its first period."""
    if not len(runs):
        return [b" ".join(words) for words in documents]
    edges = np.zeros(int(starts[-1]) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(edges[:-1]) == 0
    touched = set((np.searchsorted(starts, runs[:, 0], "right") - 1).tolist())
    return [
        b" ".join(compress(words, kept[starts[d] : starts[d + 1]].tolist()) if d in touched else words)
        for d, words in enumerate(documents)
    ]


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    least_repeats: int = LEAST_REPEATS,
) -> DataFrame:
    """(id, runs, collapsed) of every document: its runs as (start, length, period) in words, by start and
    period, and its words joined by one blank without those that a run repeats."""
    if least_repeats < LEAST_REPEATS:
        raise ValueError(f"a run repeats its period at least {LEAST_REPEATS} times")
    workers_see_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, documents in _chunks(batches):
            runs, starts = runs_of(documents, least_words, least_repeats)
            owner = np.searchsorted(starts, runs[:, 0], "right") - 1
            # empty documents share their start with the next one, which is the last of that start
            per_document = np.bincount(owner, minlength=len(documents))
            fields = [pa.array(runs[:, 0] - starts[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(per_document)], pa.int32()), pa.StructArray.from_arrays(fields, fields=list(RUN))
            )
            texts = pa.array(_collapsed(documents, runs, starts), pa.binary())
            yield pa.RecordBatch.from_arrays([ids, lists, texts], names=["id", "runs", "collapsed"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    schema = f"id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary"
    found = narrow.mapInArrow(run, schema)
    return found.select(F.col("id").alias(id_col), "runs", F.col("collapsed").cast("string").alias("collapsed"))
