"""Token counts of piece models by rank-synchronous merging of ragged arrays.

A text is normalised by the library and cut where no piece of the vocabulary can reach across:
before a run of word marks, and between two characters that stand side by side in no piece.
What lies between cuts is merged on its own, with the same result as inside the whole text.

The cuts' symbols of a batch lie in one flat array. In a step every sequence finds the best rank
among its neighbouring pairs and joins the leftmost pair of that rank, all sequences at once,
until no pair is in the vocabulary; the survivors are counted. Sequences over ``LONGEST``
symbols, where a step per merge would be quadratic, are merged by a heap in the same order.
Counts of words are remembered for a while, since most words of a text are common ones.

Defined cases: null and empty texts have 0 bytes and 0 tokens. Bytes that are not UTF-8 count as
the replacement character. Other columns are ignored; every row gives one row.
"""

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.llm.common import workers_see_package

MARK = "▁"
LONGEST = 256
WORDS_AT_ONCE = 200_000
CACHED_WORDS = 400_000
NONE = np.int32(2**31 - 1)  # rank of a pair that is no piece
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceCounter:
    """Counts tokens as the model's own library does, for BPE models with byte fallback."""

    def __init__(self, model_file: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib = self.library
        ids = range(lib.get_piece_size())
        if not any(lib.is_byte(i) for i in ids):
            raise ValueError("the model has no byte fallback")
        special = (lib.is_control, lib.is_unknown, lib.is_byte, lib.is_unused)
        plain = [i for i in ids if not any(kind(i) for kind in special)]
        pieces = [lib.id_to_piece(i) for i in plain]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece has a word mark inside")
        scores = {s: r for r, s in enumerate(sorted({lib.get_score(i) for i in plain}, reverse=True))}
        rank = {p: scores[lib.get_score(i)] for p, i in zip(pieces, plain, strict=True)}
        chars = sorted(set("".join(pieces)) - rank.keys())  # inside pieces, but no piece
        self._tables(pieces + chars, rank)

    def _tables(self, symbols: list[str], rank: dict[str, int]) -> None:
        number = {s: n for n, s in enumerate(symbols)}
        self.size = len(symbols)
        self.tokens = np.array([1 if s in rank else len(s.encode()) for s in symbols], np.int64)
        self.of_char = np.full(0x110000, -1, np.int32)
        pairs: dict[int, tuple[int, int]] = {}
        beside = set()
        for piece, place in rank.items():
            for cut in range(1, len(piece)):
                beside.add((ord(piece[cut - 1]) << 21) | ord(piece[cut]))
                a, b = number.get(piece[:cut]), number.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = (place, number[piece])
        for s, n in number.items():
            if len(s) == 1:
                self.of_char[ord(s)] = n
        self.beside = np.array(sorted(beside), np.int64)
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in self.pair_keys.tolist()], np.int32)
        self.pair_piece = np.array([pairs[k][1] for k in self.pair_keys.tolist()], np.int32)
        self.pairs = pairs
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text."""
        totals = np.zeros(len(texts), np.int64)
        words: list[str] = []
        owners: list[tuple[int, int]] = []
        for i, text in enumerate(texts):
            found = (m.group() for m in _WORD.finditer(self.library.normalize(text or "")))
            while part := list(islice(found, WORDS_AT_ONCE - len(words))):
                words += part
                owners.append((i, len(part)))
                if len(words) == WORDS_AT_ONCE:
                    self._add(words, owners, totals)
                    words, owners = [], []
        self._add(words, owners, totals)
        return totals

    def _add(self, words: list[str], owners: list[tuple[int, int]], totals: np.ndarray) -> None:
        fresh = list(set(words) - self.known.keys())
        if len(self.known) + len(fresh) > CACHED_WORDS:
            self.known.clear()
            fresh = list(set(words))
        self.known.update(zip(fresh, self.word_counts(fresh).tolist(), strict=True))
        each = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        at = 0
        for i, n in owners:
            totals[i] += each[at : at + n].sum()
            at += n

    def word_counts(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each word, merged together in ragged arrays."""
        if not words:
            return np.zeros(0, np.int64)
        lengths = np.array([len(w) for w in words])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        symbols = self.of_char[codes]
        joined = _among(self.beside, (codes[:-1] << 21) | codes[1:]) & (word[1:] == word[:-1])
        sequence = np.concatenate([[0], np.cumsum(~joined)])
        first = np.concatenate([[0], np.flatnonzero(~joined) + 1])
        sizes = np.diff(np.append(first, len(codes)))
        counts = np.zeros(len(sizes), np.int64)
        alone = sizes == 1  # a single character, known or not
        single = first[alone]
        counts[alone] = np.where(
            symbols[single] >= 0, self.tokens[symbols[single]], _utf8_length(codes[single])
        )
        for s in np.flatnonzero(sizes > LONGEST):
            counts[s] = self._by_heap(symbols[first[s] : first[s] + sizes[s]].tolist())
        ragged = (sizes > 1) & (sizes <= LONGEST)
        use = ragged[sequence]
        self._merge(symbols[use].astype(np.int64), sequence[use], counts)
        return np.bincount(word[first], counts, len(words)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left * self.size + right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        known = self.pair_keys[at] == keys
        return np.where(known, self.pair_rank[at], NONE), self.pair_piece[at]

    def _merge(self, symbols: np.ndarray, sequence: np.ndarray, counts: np.ndarray) -> None:
        """Merge rank by rank; sequences without a pair left add their survivors to ``counts``."""
        rank = np.full(len(symbols), NONE, np.int32)
        piece = np.zeros(len(symbols), np.int64)
        inside = np.flatnonzero(sequence[1:] == sequence[:-1])
        if len(inside):
            rank[inside], piece[inside] = self._ranks(symbols[inside], symbols[inside + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], sequence[1:] != sequence[:-1]]))
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(rank, starts)
            done = best == NONE
            if done.any():
                over = np.repeat(done, sizes)
                np.add.at(counts, sequence[over], self.tokens[symbols[over]])
                symbols, sequence, rank, piece = (x[~over] for x in (symbols, sequence, rank, piece))
                if not len(symbols):
                    return
                best, sizes = best[~done], sizes[~done]
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            own = sequence[hits]
            hits = hits[np.concatenate([[True], own[1:] != own[:-1]])]  # the leftmost of each
            symbols[hits] = piece[hits]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            hits = hits - np.arange(len(hits))  # places after the removal
            symbols, sequence, rank, piece = (x[keep] for x in (symbols, sequence, rank, piece))
            changed = np.concatenate([hits, hits - 1])
            changed = changed[(changed >= 0) & (changed < len(symbols) - 1)]
            same = sequence[changed] == sequence[changed + 1]
            rank[hits] = NONE
            at = changed[same]
            rank[at], piece[at] = self._ranks(symbols[at], symbols[at + 1])

    def _by_heap(self, symbols: list[int]) -> int:
        """The same merges for one long sequence, with a heap of (rank, place)."""
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def look(i: int, j: int) -> None:
            if i >= 0 and j >= 0:
                pair = self.pairs.get(symbols[i] * self.size + symbols[j])
                if pair:
                    heapq.heappush(heap, (pair[0], i, symbols[i], symbols[j]))

        for i in range(len(symbols) - 1):
            look(i, i + 1)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i] = self.pairs[a * self.size + b][1]
            symbols[j] = -2
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            look(before[i], i)
            look(i, after[i])
        return int(sum(self.tokens[s] for s in symbols if s >= 0))


def _among(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return table[at] == keys


def _utf8_length(codes: np.ndarray) -> np.ndarray:
    return 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)


@lru_cache(maxsize=4)
def counter(model_file: str) -> PieceCounter:
    """One counter per Python worker, kept between tasks."""
    return PieceCounter(model_file)


def token_counts(
    docs: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document; no shuffle.

    ``model_file`` is read by the workers and has to be at the same place on each.
    """
    workers_see_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_file).counts
        for batch in batches:
            raw = batch.column(1).to_pylist()
            tokens = count([None if x is None else x.decode("utf-8", "replace") for x in raw])
            columns = [
                batch.column(0),
                pa.array([len(x or b"") for x in raw], pa.int64()),
                pa.array(tokens),
                pa.array(tokens > limit),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    )
    return narrow.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
