"""Token-id files: one id array with Elias-Fano document boundaries, in document order.

A segment is a run of documents in ascending id order:

    4 bytes "TEF1", 1 byte id width (2 or 4), 3 bytes 0, 8 bytes number of ids
    the ids of all documents, little-endian
    Elias-Fano code of the document ends (``elias_fano``)

Segments close at ``segment_ids`` ids, so writers and readers hold one at a time. They are stored as
rows of a Parquet table in the order of its ``part`` and ``seq``: Spark's committer then takes care of
lost tasks, and any file system that Spark knows will do. ``part_start`` is the number of ids
before the segment in its part. The ids before a part are summed from the parts' sizes.

Texts are encoded by the tokenizers library. For byte-level models a space with the letters behind
it is always split off before merging, whatever stands around it. So texts are cut around these
words, some texts at once by arrays of their code points, and each distinct word, as well as what lies between, is
encoded by the library once for a while. Other models get whole texts. The ids of some texts are put together at once,
each with its end id behind it.

Readers find documents by select on the code of the ends, some thousand at a time.

Defined cases: null and empty texts have the end id alone. A null id comes first; rows with equal
ids follow in order of the text's hash. An empty table gives empty files. Other columns are ignored.
"""

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from txnmill.llm import elias_fano
from txnmill.llm.common import shuffle_partitions, workers_see_package

SEGMENT_IDS = 1_000_000
RUNS_AT_ONCE = 800_000
CHARS_A_RUN = 5  # or so
CACHED_RUNS = 1_000_000
WORDS_AT_ONCE = 4096
BOUNDS_AT_ONCE = 4096
_HEAD = struct.Struct("<4sB3xQ")
SEGMENT_SCHEMA = "part int, seq int, part_start long, n_ids long, doc_ids array<long>, payload binary"
# Words of letters that are letters in every version of Unicode, not followed by more of a word.
_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"
_WORD = re.compile(f" {_LETTER}+")
_GOES_ON, _IS_LETTER = 1, 2
_SPACE = "\u0120"  # how byte-level models write a space


_END = None  # stands for the end id among runs, which are texts
_AFTER = "\0"  # behind every text while texts are cut; no part of a word


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of every code point, whether words consist of it or, if not, whether it goes on with a word."""
    kinds = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, range(len(kinds))))
    for kind, pattern in ((_GOES_ON, r"\w"), (_IS_LETTER, _LETTER)):
        kinds[[ord(c) for c in re.findall(pattern, every)]] = kind
    return kinds


def _cut(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The runs of some texts in a row, behind each text one more of one character, and the numbers of these."""
    whole = _AFTER.join([*texts, ""])
    codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
    kinds = _kinds()[codes]
    letter = np.concatenate([[False], kinds == _IS_LETTER])
    turns = np.flatnonzero(letter[1:] != letter[:-1])
    starts, ends = turns[::2], turns[1::2]
    # what lies before the first character is the last one, which is no space
    word = (codes[starts - 1] == ord(" ")) & (kinds[ends] == 0)
    after = np.cumsum([len(text) + 1 for text in texts])
    cut = np.zeros(len(codes) + 1, bool)
    for places in (starts[word] - 1, ends[word], after - 1, after):
        cut[places] = True
    cut[0] = True
    at = np.flatnonzero(cut)
    last = np.searchsorted(at, after) - 1
    utf8 = whole.encode()
    if len(utf8) > len(codes):
        widths = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        at = np.concatenate([[0], np.cumsum(widths)])[at]
    buffers = [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(utf8)]
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, buffers), last


class _Numbers(dict):
    """Numbers of runs in order of their first use, and which of them came up since ``fresh`` was emptied."""

    def __init__(self, known=()):
        super().__init__(known)
        self.fresh: list[str | None] = []

    def __missing__(self, run: str | None) -> int:
        number = self[run] = len(self)
        self.fresh.append(run)
        return number


class Encoder:
    """Ids of whole texts, equal to the library's ``encode(text, add_special_tokens=False)``."""

    def __init__(self, tokenizer_file: str):
        self.library = Tokenizer.from_file(tokenizer_file)
        self.library.no_truncation()
        self.library.no_padding()
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_runs = self._cuts_at_space(spec)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.most = max(vocabulary.values(), default=0)
        self.at_space = np.zeros(self.most + 1, bool)
        self.at_space[[number for token, number in vocabulary.items() if token.startswith(_SPACE)]] = True
        self.known = _Numbers()
        self.flat = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)
        self.uses = np.empty(0, np.int64)
        self.end_id: int | None = None

    @staticmethod
    def _cuts_at_space(spec: dict) -> bool:
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens", [])
        plain = all(
            not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) for t in added
        )
        return (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and plain
        )

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text in turn."""
        for ids, sizes in self.blocks(texts, None):
            yield from np.split(ids, np.cumsum(sizes)[:-1])

    def blocks(self, texts: list[str], end_id: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of some texts in a row, each with ``end_id`` behind it if there is one, and how many each has."""
        ends = [] if end_id is None else [end_id]
        if not self.by_runs:
            for text in texts:
                ids = [*self.library.encode(text, add_special_tokens=False).ids, *ends]
                yield np.array(ids, np.uint32), np.array([len(ids)])
            return
        if ends and self.end_id != end_id:
            self._forget_all(end_id)
        some: list[str] = []
        size = 0
        for text in texts:
            some.append(text)
            size += len(text) + 1
            if size >= RUNS_AT_ONCE * CHARS_A_RUN:
                yield self._block(some, bool(ends))
                some, size = [], 0
        if some:
            yield self._block(some, bool(ends))

    def _block(self, texts: list[str], with_end: bool) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > CACHED_RUNS:
            self._forget()
        runs, last = _cut(texts)
        distinct = runs.dictionary_encode()
        numbers = map(self.known.__getitem__, distinct.dictionary.to_pylist())
        which = np.fromiter(numbers, np.int64, len(distinct.dictionary))[distinct.indices.to_numpy()]
        bounds = np.concatenate([[0], last + 1])
        if with_end:
            which[last] = self.known[_END]
        else:
            which = np.delete(which, last)
            bounds -= np.arange(len(bounds))
        ids, sizes = self._ids(which)
        return ids, np.diff(np.concatenate([[0], np.cumsum(sizes)])[bounds])

    def _ids(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the runs with these numbers in a row, and how many each has."""
        if self.known.fresh:
            self._learn(self.known.fresh)
            self.known.fresh = []
        self.uses += np.bincount(which, minlength=len(self.uses))
        sizes = self.lengths[which]
        before = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts[which] - before, sizes)
        return self.flat[at], sizes

    def _forget_all(self, end_id: int) -> None:
        """Start anew with another end id."""
        self.end_id, self.known = end_id, _Numbers()
        self.flat = np.empty(0, np.uint32)
        self.starts, self.lengths, self.uses = (np.empty(0, np.int64) for _ in range(3))

    def _forget(self) -> None:
        """Drop the least used runs, at least half of them."""
        limit = max(1, int(np.median(self.uses))) if len(self.uses) else 0
        keep = np.flatnonzero(self.uses > limit)
        place = np.full(len(self.uses), -1)
        place[keep] = np.arange(len(keep))
        self.known = _Numbers((run, int(place[i])) for run, i in self.known.items() if place[i] >= 0)
        sizes = self.lengths[keep]
        before = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts[keep] - before, sizes)
        self.flat, self.starts, self.lengths = self.flat[at], before, sizes
        self.uses = self.uses[keep] // 2

    def _learn(self, fresh: list[str | None]) -> None:
        """Ids of runs that have the next numbers."""
        # the words come first, then the others, then the end
        kind = np.array([2 if run is _END else 0 if _WORD.fullmatch(run) else 1 for run in fresh])
        order = np.argsort(kind, kind="stable")
        words, others = ([fresh[i] for i in order[kind[order] == k].tolist()] for k in (0, 1))
        coded = [np.array(one.ids, np.uint32) for one in self.library.encode_batch_fast(others, add_special_tokens=False)]
        parts = [*self._words(words), *((ids, [len(ids)]) for ids in coded)]
        if _END in fresh:
            parts.append(([self.end_id], [1]))
        flat = np.concatenate([ids for ids, _ in parts]).astype(np.uint32)
        lengths = np.concatenate([sizes for _, sizes in parts]).astype(np.int64)
        starts = np.empty(len(fresh), np.int64)
        starts[order] = len(self.flat) + np.cumsum(lengths) - lengths
        sizes = np.empty(len(fresh), np.int64)
        sizes[order] = lengths
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, sizes])
        self.uses = np.concatenate([self.uses, np.zeros(len(fresh), np.int64)])

    def _words(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of words and how many each has. They are encoded as a text of many words, which the
        library cuts before every space, so each word starts with an id that starts with one."""
        for i in range(0, len(words), WORDS_AT_ONCE):
            some = words[i : i + WORDS_AT_ONCE]
            one = self.library.encode_batch_fast(["".join(some)], add_special_tokens=False)[0]
            ids = np.array(one.ids, np.uint32)
            first = np.flatnonzero(self.at_space[ids])
            if len(first) != len(some) or first[0] != 0:
                raise ValueError("the tokenizer does not cut before every space")
            yield ids, np.diff(first, append=len(ids))


@lru_cache(maxsize=4)
def encoder(tokenizer_file: str) -> Encoder:
    """One encoder per Python worker, kept between tasks."""
    return Encoder(tokenizer_file)


# Segments


def segment_bytes(ids: np.ndarray, sizes: np.ndarray, width: int) -> bytes:
    """A segment of documents of these sizes, whose ids lie in a row."""
    ids = np.asarray(ids, f"<u{width}")
    return _HEAD.pack(b"TEF1", width, len(ids)) + ids.tobytes() + elias_fano.encode(np.cumsum(sizes))


class Segment:
    """Reader of one segment; document ``i`` is ``ids[start(i):start(i + 1)]``."""

    def __init__(self, data: bytes):
        magic, width, n = _HEAD.unpack_from(data)
        if magic != b"TEF1":
            raise ValueError("not a token-id segment")
        self.ids = np.frombuffer(data, f"<u{width}", n, _HEAD.size)
        self.ends = elias_fano.Sequence(memoryview(data)[_HEAD.size + n * width :])

    def __len__(self) -> int:
        return len(self.ends)

    def start(self, i: int) -> int:
        return self.ends[i - 1] if i else 0

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.start(i) : self.start(i + 1)]

    def bounds(self, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the documents ``first`` to ``end - 1`` start and end, by select."""
        ends = self.ends.select(np.arange(first, end))
        return np.concatenate([[self.start(first)], ends[:-1]])[: end - first], ends


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode every text and write the segments to ``path``, in ascending order of the ids.

    ``tokenizer_file`` is read by the workers and has to be at the same place on each.
    """
    spark = docs.sparkSession
    workers_see_package(spark)
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = narrow.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer_file)
        width = 2 if max(code.most, end_id) < 2**16 else 4
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        size = 0
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        fields = [f.split()[0] for f in SEGMENT_SCHEMA.split(", ")]

        def segment() -> pa.RecordBatch:
            ids, sizes = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            names = [name for h in held for name in h[2].to_pylist()]
            values = [[part], [seq], [before], [size], [names], [segment_bytes(ids, sizes, width)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=fields
            )

        for batch in batches:
            done = 0
            for ids, sizes in code.blocks(batch.column(1).to_pylist(), end_id):
                names = batch.column(0).slice(done, len(sizes))
                done += len(sizes)
                ends = np.cumsum(sizes)
                first = 0
                while first < len(sizes):
                    passed = int(ends[first - 1]) if first else 0
                    # up to the document that fills the segment
                    last = min(int(np.searchsorted(ends, passed + segment_ids - size)) + 1, len(sizes))
                    until = int(ends[last - 1])
                    held.append((ids[passed:until], sizes[first:last], names.slice(first, last - first)))
                    size += until - passed
                    first = last
                    if size >= segment_ids:
                        yield segment()
                        before, seq, held, size = before + size, seq + 1, [], 0
        if held:
            yield segment()

    ranged.mapInArrow(run, SEGMENT_SCHEMA).write.parquet(path)


def read_token_files(docs_path: str, spark) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the segments.

    ``start`` is the number of ids of all documents before. The crc covers the document's ids as
    unsigned little-endian numbers of 32 bits.
    """
    workers_see_package(spark)
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(docs_path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn(
        "base", F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    based = segments.join(F.broadcast(parts.select("part", "base")), "part")  # a row per written part
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, names, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                segment = Segment(payload)
                for first in range(0, len(segment), BOUNDS_AT_ONCE):
                    starts, ends = segment.bounds(first, min(first + BOUNDS_AT_ONCE, len(segment)))
                    offset = int(starts[0])
                    wide = memoryview(segment.ids[offset : int(ends[-1])].astype("<u4")).cast("B")
                    places = zip(((starts - offset) * 4).tolist(), ((ends - offset) * 4).tolist(), strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[first : first + len(ends)], pa.int64()),
                            pa.array(starts + base),
                            pa.array(ends - starts),
                            pa.array([zlib.crc32(wide[a:b]) for a, b in places], pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return based.select(
        (F.col("base") + F.col("part_start")).alias("base"), "doc_ids", "payload"
    ).mapInArrow(run, schema)
