"""Document fingerprints by prefix polynomial hashes.

A text's prefix array holds ``S(i) = sum of c(j) * B**j for j < i`` modulo a prime, for two primes
at once. A span's hash is the difference of two entries, and spans at different places are compared
after a shift by a power of the base, so any two spans, of one text or of two, are compared in
constant time. The longest common extension of two places is found by binary search over that.

The fingerprint starts with the hash of the whole text under four primes, and its length. Behind that is the text's
prefix array at some places, as the spans between them: hash, length, and strength of the cut before each. A
place is a cut if the hash of the ``WINDOW`` characters from there, mixed, starts with as many zero bits as the level
asks for. So cuts depend on the characters around them alone, texts that share a stretch share the cuts in
it, and an edit moves no others. The level follows from the length, so that some 32 to 64 cuts are to be expected,
and rises in texts that repeat a window so often that more than ``MOST_CUTS`` come up.

Likeness is taken from two fingerprints. The finer one is brought to the level of the other: the hash of two spans
in a row follows from theirs. Then the spans of one are looked up in the other; from each that is
found, binary search over the places finds the longest run of spans that both have. Likeness is the length
of these runs in both texts as a share of both lengths: two texts of one length that share half of it come to about
0.5. It is 1 for equal fingerprints only.

Neighbours in id order are joined in one shuffle: ids are cut into ranges by quantiles, the first
document of a range also goes to the range before, and each range is streamed in order.

Defined cases: null is the empty text; two empty texts have likeness 1. Texts that repeat one short block throughout
have no cuts and are alike only to equal ones. Null ids come first, rows with
equal ids follow in order of the text. A single document is its own next one. Other columns are
ignored.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.llm.common import shuffle_partitions, text_or_empty, workers_see_package

# Primes below 2**31, so that products fit in 64 bits, and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (911382323, 972663749, 1314520547, 1618033989)
ARRAYS = 2  # primes of the prefix arrays; the others strengthen the fingerprint


WINDOW = 6
LEAST_LEVEL, MEAN_CUTS, MOST_CUTS = 2, 64, 192
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """Powers of a base modulo a prime, as many as were asked for so far."""

    def __init__(self, base: int, prime: int):
        self.base, self.prime = base, prime
        self.table = np.array([1], np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            step = np.uint64(pow(self.base, len(self.table), self.prime))
            self.table = np.concatenate([self.table, self.table * step % np.uint64(self.prime)])
        return self.table[:n]

    def at(self, places: np.ndarray) -> np.ndarray:
        return self.upto(int(places.max(initial=0)) + 1)[places]


_POWERS = [Powers(b, p) for b, p in zip(BASES, PRIMES, strict=True)]
_BACK = Powers(pow(BASES[0], -1, PRIMES[0]), PRIMES[0])


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint64(1)
        self.n = len(codes)
        self.sums, whole = [], []
        for k, power in enumerate(_POWERS):
            terms = codes * power.upto(self.n) % np.uint64(power.prime)
            if k < ARRAYS:
                sums = np.zeros(self.n + 1, np.uint64)
                np.cumsum(terms, out=sums[1:])
                self.sums.append(sums % np.uint64(power.prime))
                whole.append(int(self.sums[k][-1]))
            else:
                whole.append(int(terms.sum()) % power.prime)
        self.fingerprint = "".join(f"{x:08x}" for x in whole) + f"{self.n:x}"

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """Hash of ``text[start:end]`` still multiplied by ``B**start``."""
        return tuple(
            (int(s[end]) - int(s[start])) % p for s, p in zip(self.sums, PRIMES, strict=False)
        )

    def equal(self, start: int, other: "PrefixHash", other_start: int, length: int) -> bool:
        """Whether two spans of one length are equal."""
        a = self.span(start, start + length)
        b = other.span(other_start, other_start + length)
        shift = other_start - start
        for x, y, base, prime in zip(a, b, BASES, PRIMES, strict=False):
            if shift >= 0:
                x = x * pow(base, shift, prime) % prime
            else:
                y = y * pow(base, -shift, prime) % prime
            if x != y:
                return False
        return True

    def extension(self, start: int, other: "PrefixHash", other_start: int) -> int:
        """Length of the longest common extension to the right of two places."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(start, other, other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def extension_left(self, end: int, other: "PrefixHash", other_end: int) -> int:
        """Length of the longest common extension to the left of two places."""
        low, high = 0, min(end, other_end)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(end - middle, other, other_end - middle, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def windows(self) -> np.ndarray:
        """Mixed hash of the window that starts at each place, 32 bits."""
        if self.n < WINDOW:
            return np.empty(0, np.uint64)
        prime = np.uint64(PRIMES[0])
        span = self.sums[0][WINDOW:] + prime - self.sums[0][:-WINDOW]
        at_zero = span % prime * _BACK.upto(len(span)) % prime
        return at_zero * _MIX >> np.uint64(20) & np.uint64(0xFFFFFFFF)

    def spans(self) -> list[tuple[int, int, int]]:
        """(hash, length, strength of the cut before) of the spans between cuts; the first has no cut
        before it and strength 0."""
        mixed = self.windows()
        level = _level(self.n)
        places = np.flatnonzero(mixed < np.uint64(1 << (32 - level)))
        places = places[places > 0]
        while len(places) > MOST_CUTS:
            level += 1
            places = places[mixed[places] < np.uint64(1 << (32 - level))]
        prime = np.uint64(PRIMES[0])
        ends = np.concatenate([[0], places, [self.n]])
        sums = self.sums[0][ends]
        hashes = (sums[1:] + prime - sums[:-1]) % prime * _BACK.at(ends[:-1]) % prime
        strength = [33 - int(m).bit_length() for m in mixed[places].tolist()]  # leading zeros of 32, and one
        return list(zip(hashes.tolist(), np.diff(ends).tolist(), [0, *strength], strict=True))

    def print(self) -> "Print":
        return Print(self.fingerprint, self.n, self.spans())


def _level(length: int) -> int:
    """Zero bits that a cut's window hash starts with, in texts of this length."""
    return max(LEAST_LEVEL, (length // MEAN_CUTS).bit_length())


class Print:
    """A fingerprint; ``str`` gives its text and ``parse`` takes that."""

    def __init__(self, whole: str, n: int, spans: list[tuple[int, int, int]]):
        self.whole, self.n, self.spans = whole, n, spans

    def __str__(self) -> str:
        return self.whole + "".join([f".{h:x}-{n:x}-{cut:x}" for h, n, cut in self.spans])

    @classmethod
    def parse(cls, text: str) -> "Print":
        whole, *spans = text.split(".")
        return cls(whole, int(whole[32:], 16), [tuple(int(x, 16) for x in span.split("-")) for span in spans])

    def level(self) -> int:
        """Strength that the cuts have at least, as far as can be told."""
        return max(_level(self.n) + 1, min([cut for _, _, cut in self.spans[1:]], default=0))

    def coarse(self, level: int) -> list[tuple[int, int]]:
        """(length, hash) of the spans between cuts of at least this strength."""
        joined: list[tuple[int, int]] = []
        for h, n, cut in self.spans:
            if cut >= level or not joined:
                joined.append((n, h))
            else:
                before, first = joined[-1]
                joined[-1] = before + n, (first + pow(BASES[0], before, PRIMES[0]) * h) % PRIMES[0]
        return joined


class Prefixes:
    """Prefix array at the cuts: lengths and hashes of all before, and the power that a hash there carries."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.at, self.sums, self.powers = [0], [0], [1]
        for n, h in spans:
            self.sums.append((self.sums[-1] + self.powers[-1] * h) % PRIMES[0])
            self.powers.append(self.powers[-1] * pow(BASES[0], n, PRIMES[0]) % PRIMES[0])
            self.at.append(self.at[-1] + n)

    def equal(self, i: int, other: "Prefixes", j: int, m: int) -> bool:
        """Whether ``m`` spans from ``i`` are the text of as many from ``j``."""
        if self.at[i + m] - self.at[i] != other.at[j + m] - other.at[j]:
            return False
        mine = (self.sums[i + m] - self.sums[i]) * other.powers[j]
        return (mine - (other.sums[j + m] - other.sums[j]) * self.powers[i]) % PRIMES[0] == 0

    def extension(self, i: int, other: "Prefixes", j: int) -> int:
        """Number of spans of the longest run that both have from these cuts, by binary search; at least one."""
        low, high = 1, min(len(self.at) - i, len(other.at) - j) - 1
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(i, other, j, middle):
                low = middle
            else:
                high = middle - 1
        return low


def likeness(one: str, other: str) -> float:
    """Likeness of two fingerprints, from 0 to 1; 1 for equal ones only."""
    return alike(Print.parse(one), Print.parse(other))


def alike(one: Print, other: Print) -> float:
    if one.whole == other.whole:
        return 1.0
    level = max(one.level(), other.level())
    a, b = one.coarse(level), other.coarse(level)
    where: dict[tuple[int, int], list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        where.setdefault(b[j], []).append(j)
    if where.keys().isdisjoint(a):
        return 0.0
    first, second = Prefixes(a), Prefixes(b)
    used = [False] * len(b)
    common = i = 0
    while i < len(a):
        places = where.get(a[i], [])
        while places and used[places[-1]]:
            places.pop()
        if not places:
            i += 1
            continue
        j = places[-1]
        run = first.extension(i, second, j)
        free = next((k for k in range(run) if used[j + k]), run)
        used[j : j + free] = [True] * free
        common += first.at[i + free] - first.at[i]
        i += free
    return min(2 * common / (one.n + other.n), 1 - 1 / (one.n + other.n + 1))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much, or all, of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_following(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(bucket, is_next, doc_id, h, text), dealt by ranges of the id and sorted: the rows of a
    bucket, and behind them the first document of the next bucket, marked ``is_next``."""
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text")
    )
    buckets = 4 * shuffle_partitions(spark)
    cuts = narrow.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets)
    splits = [-math.inf, *sorted({*cuts, 0.0}), math.inf]
    number = F.col("doc_id").cast("double")
    dealer = Bucketizer(splits=splits, inputCol="number", outputCol="range", handleInvalid="keep")
    dealt = dealer.transform(narrow.withColumn("number", F.coalesce(number, F.lit(-math.inf))))
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("range")).cast("int")
    dealt = dealt.select(
        bucket.alias("bucket"), "doc_id", F.xxhash64("text").alias("h"), "text"
    )
    # One row per bucket, so as many as there are partitions.
    first = F.min(F.struct("doc_id", "h")).alias("first")
    heads = dealt.groupBy("bucket").agg(first).orderBy("bucket").collect()
    before = [h["bucket"] for h in heads[-1:] + heads[:-1]]
    small = spark.createDataFrame(
        [(h["bucket"], h["first"]["doc_id"], h["first"]["h"], b) for h, b in zip(heads, before, strict=True)],
        "bucket int, first_id long, first_h long, before int",
    )
    leads = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h"))
    own = F.struct(F.col("bucket"), F.lit(False).alias("is_next"))
    again = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("is_next"))
    to = F.when(leads, F.array(own, again)).otherwise(F.array(own))
    rows = dealt.join(F.broadcast(small), "bucket").select(F.explode(to).alias("to"), "doc_id", "h", "text")
    order = ["bucket", "is_next", F.col("doc_id").asc_nulls_first(), "h"]
    return (
        rows.select("to.*", "doc_id", "h", "text")
        .repartition(shuffle_partitions(spark), "bucket")
        .sortWithinPartitions(*order)
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text is ``edited(text, next text)`` in id order; the last document is followed by
    the first. Likeness is that of the fingerprints.
    """
    workers_see_package(docs.sparkSession)
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # bucket, id, text, length and fingerprint of the row before
        for batch in batches:
            out = []
            for bucket, is_next, doc_id, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = raw.decode("utf-8", "replace")
                if held is None and is_next:
                    continue  # an equal copy of the next document
                hashed = PrefixHash(text)
                now = (bucket, doc_id, text, hashed.n, hashed.print())
                if held is not None:
                    out.append(_row(held, now))
                held = None if is_next else now
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names
                )

    ordered = with_following(docs, id_col, text_col)
    return ordered.select(
        "bucket", "is_next", "doc_id", F.col("text").cast("binary").alias("text")
    ).mapInArrow(run, schema)


def _row(held, now) -> tuple:
    _, doc_id, text, length, own = held
    new = edited(text, now[2])
    changed = PrefixHash(new).print()
    sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, length, sha, str(own), str(changed), alike(own, changed), alike(own, now[4]))
