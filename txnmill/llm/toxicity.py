"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text and their first four, five and six letters, hashed.
A model has one weight per feature, shared by all grades, and one ordered threshold per grade:
``P(grade >= k) = sigmoid(w x - threshold_k)``. Weights are not negative and features are such that
flagged texts have significantly more often, so harmless words, however many, excuse nothing. The expected severity is the sum of these
probabilities; a text is rejected if a grade above 0 is more likely than not.

Fitting takes at most ``sample_rows`` labelled documents (default 20,000), half of them flagged
if there are as many, drawn by a hash of their ids and weighted back to the share that all labels
have. Features are chosen from document counts over the sample, which are summed by Spark, by the
likelihood ratio at a fixed significance; only the chosen features (``most_features``, default 4,096) and the sample's use of them, two bytes each,
reach the driver. Scoring covers every document and whole texts, in one pass without a shuffle.

Labels are grades 0, 1, 2, ... If only a flag exists, ``flags_to_grades`` splits flagged documents
at the median number of tell-tale words into grades 1 and 2.

Defined cases: null, empty and wordless texts have no features and severity of the thresholds
alone; they are never rejected. Labels with a null id or grade count for nothing, of several for
one id the highest counts, and of several documents with one id one is fitted. Without labels of
both kinds the model rejects nothing. Other columns are ignored or passed through.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmill.llm.common import staged, workers_see_package

SPACE = 2**22  # size of the hashed feature space
PREFIXES = (4, 5, 6)
LEAST_Z = 2.5  # significance of a feature, the same at every size of the sample
CACHED_WORDS = 400_000
_WORD = re.compile(r"\w+")


def word_features(word: str) -> list[int]:
    """Hashed features of one lower-case word: itself and its beginnings."""
    names = ["=" + word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]
    return [xxhash.xxh64_intdigest(name) % SPACE for name in names]


class Reader:
    """Distinct features of texts; remembers words, so that each is hashed once for a while."""

    def __init__(self, wanted: set[int] | None = None):
        self.wanted, self.known = wanted, {}

    def word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            found = word_features(word)
            if self.wanted is not None:
                found = [f for f in found if f in self.wanted]
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = found = tuple(found)
        return found

    def features(self, text: str | None) -> np.ndarray:
        out: set[int] = set()
        for word in set(_WORD.findall((text or "").lower())):
            out.update(self.word(word))
        return np.fromiter(sorted(out), np.int64, len(out))

    def hits(self, text: str | None, strong: set[int]) -> int:
        """Distinct words of a text with a feature in ``strong``."""
        words = set(_WORD.findall((text or "").lower()))
        return sum(not strong.isdisjoint(self.word(w)) for w in words)


@dataclass
class Model:
    features: np.ndarray  # sorted
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one per grade above 0

    def eta(self, found: np.ndarray) -> float:
        at = np.searchsorted(self.features, found)
        at[at == len(self.features)] = 0
        hit = self.features[at] == found if len(self.features) else np.zeros(len(found), bool)
        return float(self.weights[at[hit]].sum())

    def at_least(self, eta: np.ndarray) -> np.ndarray:
        """(texts, grades above 0) probabilities of reaching each grade."""
        return _sigmoid(np.asarray(eta)[:, None] - self.thresholds[None])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


# Fitting


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    flag_col: str | None = "toxic",
    grade_col: str | None = None,
    sample_rows: int = 20_000,
    most_features: int = 4096,
    seed: int = 5,
) -> Model:
    """Fit on a bounded sample of labelled documents, see the module text."""
    if most_features > 2**16:
        raise ValueError("at most 65,536 features")
    workers_see_package(docs.sparkSession)
    label = F.col(grade_col or flag_col).cast("int")
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), label.alias("label"))
    known = known.dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = dict(known.groupBy(F.col("label") > 0).count().collect())
    nothing = Model(np.empty(0, np.int64), np.empty(0), np.array([40.0]))  # rejects no text
    if len(counts) < 2:
        return nothing
    order = F.xxhash64(F.lit(seed), "doc_id")
    half = sample_rows // 2
    take = {True: half, False: sample_rows - half}
    ids = [
        known.filter((F.col("label") > 0) == flag).orderBy(order, "doc_id").limit(n)
        for flag, n in take.items()
    ]
    drawn = F.broadcast(ids[0].union(ids[1]))  # at most sample_rows pairs of numbers
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = texts.join(drawn, "doc_id").dropDuplicates(["doc_id"])
    sample = staged(sample, "toxicity-sample")
    kinds = sample.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") > 0)).first()
    if not all(kinds):  # labels of documents that are not there
        return nothing
    chosen, strong = _choose(sample, most_features, *kinds)
    rows = _encoded(sample, chosen, strong).orderBy("doc_id").collect()
    labels_seen = np.array([r["label"] for r in rows])
    grades = labels_seen if grade_col else flags_to_grades(labels_seen, [r["hits"] for r in rows])
    weight = np.where(
        labels_seen > 0,
        counts[True] / max(1, (labels_seen > 0).sum()),
        counts[False] / max(1, (labels_seen == 0).sum()),
    )
    return fit([np.frombuffer(r["at"], np.uint16) for r in rows], grades, chosen, weight / weight.mean())


def _choose(sample: DataFrame, most: int, all0: int, all1: int) -> tuple[np.ndarray, set[int]]:
    """Features that mark flagged sample texts, and those among them that all but prove it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = Reader(), np.zeros((2, SPACE), np.int32)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                seen[int(label.as_py() > 0)][reader.features(text.as_py())] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(seen[0][at]), pa.array(seen[1][at])], names=["f", "n0", "n1"]
        )

    counted = sample.select("text", "label").mapInArrow(count, "f long, n0 int, n1 int")
    sums = counted.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    odds = F.log((F.col("n1") + 0.5) / (all1 + 1)) - F.log((F.col("n0") + 0.5) / (all0 + 1))
    best = (
        sums.withColumn("odds", odds)
        .withColumn("z", _root_ratio(F.col("n0"), F.col("n1"), all0, all1))
        .filter((F.col("odds") > 0) & (F.col("z") >= LEAST_Z))
        .orderBy(F.desc("z"), "f")
        .limit(most)
        .select("f", "odds")
        .collect()
    )
    strong = {r["f"] for r in best if r["odds"] > 3}
    return np.array(sorted(r["f"] for r in best), np.int64), strong


def _root_ratio(n0: Column, n1: Column, all0: int, all1: int) -> Column:
    """Root of the likelihood-ratio statistic of a feature in ``n0`` and ``n1`` texts of either kind.

    Unlike odds over their deviation it does not lose a rare feature because it is rare.
    """
    total = all0 + all1

    def term(seen: Column, texts: Column, kind: int) -> Column:
        expected = texts * F.lit(kind / total)
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    have, lack = n0 + n1, F.lit(total) - n0 - n1
    terms = term(n0, have, all0) + term(n1, have, all1) + term(all0 - n0, lack, all0) + term(all1 - n1, lack, all1)
    return F.sqrt(F.greatest(F.lit(0.0), 2 * terms))


def _encoded(sample: DataFrame, chosen: np.ndarray, strong: set[int]) -> DataFrame:
    wanted = set(chosen.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(wanted)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = [np.searchsorted(chosen, reader.features(t)).astype(np.uint16).tobytes() for t in texts]
            hits = [reader.hits(t, strong) for t in texts]
            columns = [batch.column(0), batch.column(2), pa.array(at, pa.binary()), pa.array(hits, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "at", "hits"])

    return sample.select("doc_id", "text", "label").mapInArrow(
        run, "doc_id long, label int, at binary, hits int"
    )


def flags_to_grades(flags, hits) -> np.ndarray:
    """0 for unflagged texts, 1 for flagged ones with up to the median number of tell-tale words,
    2 for those with more."""
    flags, hits = np.asarray(flags), np.asarray(hits)
    flagged = flags > 0
    middle = np.median(hits[flagged]) if flagged.any() else 0
    return np.where(flagged, 1 + (hits > middle), 0)


def fit(
    rows: list[np.ndarray],
    grades: np.ndarray,
    features: np.ndarray,
    weight: np.ndarray | None = None,
    l2: float = 1e-5,
    steps: int = 500,
    rate: float = 0.1,
) -> Model:
    """Weights, none negative, and thresholds of least weighted log loss, by Adam over all rows.

    ``rows`` has the positions of each text's features. Thresholds are a first one and
    exponentials of gaps, which keeps them in order.
    """
    grades = np.asarray(grades, np.int64)
    top = max(1, int(grades.max(initial=0)))
    weight = np.ones(len(rows)) if weight is None else weight
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate([*rows, np.empty(0, np.uint16)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), lengths)
    total = weight.sum()
    params = np.zeros(len(features) + top)
    params[len(features)] = 2.0
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, free = params[: len(features)], params[len(features) :]
        thresholds = _ordered(free)
        eta = np.bincount(owner, w[flat], len(rows))
        reach = np.hstack([np.ones((len(rows), 1)), _sigmoid(eta[:, None] - thresholds), np.zeros((len(rows), 1))])
        slope = reach * (1 - reach)
        at = np.arange(len(rows))
        p = np.maximum(reach[at, grades] - reach[at, grades + 1], 1e-12)
        pull = -weight / p / total
        d_eta = pull * (slope[at, grades] - slope[at, grades + 1])
        d_thresholds = np.zeros(top + 2)
        np.add.at(d_thresholds, grades, -pull * slope[at, grades])
        np.add.at(d_thresholds, grades + 1, pull * slope[at, grades + 1])
        d_thresholds = d_thresholds[1:-1]
        d_free = np.cumsum(d_thresholds[::-1])[::-1].copy()
        d_free[1:] *= np.exp(free[1:])
        gradient = np.concatenate([np.bincount(flat, d_eta[owner], len(features)) + l2 * w, d_free])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        np.maximum(params[: len(features)], 0, out=params[: len(features)])
    return Model(features, params[: len(features)], _ordered(params[len(features) :]))


def _ordered(free: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


# Scoring


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, p_toxic, grade, rejected) of every document."""
    workers_see_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(set(model.features.tolist()))
        for batch in batches:
            reach, empty = _reach(batch.column(1), reader, model)
            padded = np.hstack([np.ones((len(reach), 1)), reach, np.zeros((len(reach), 1))])
            columns = [
                batch.column(0),
                pa.array(reach.sum(axis=1)),
                pa.array(reach[:, 0]),
                pa.array((padded[:, :-1] - padded[:, 1:]).argmax(axis=1).astype(np.int32)),
                pa.array((reach[:, 0] > 0.5) & ~empty),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "severity", "p_toxic", "grade", "rejected"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(
        run, "doc_id long, severity double, p_toxic double, grade int, rejected boolean"
    )


def _reach(texts: pa.Array, reader: Reader, model: Model) -> tuple[np.ndarray, np.ndarray]:
    found = [reader.features(t.as_py()) for t in texts]
    eta = np.array([model.eta(f) for f in found])
    return model.at_least(eta), np.array([not len(f) for f in found], bool)


def without_rejected(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    workers_see_package(docs.sparkSession)
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(set(model.features.tolist()))
        for batch in batches:
            reach, empty = _reach(batch.column(text_at), reader, model)
            yield batch.filter(pa.array((reach[:, 0] <= 0.5) | empty))

    return docs.mapInArrow(run, docs.schema)
