import random

import numpy as np
import pytest

from txnmill.llm.toxicity import Model, fit, score, train, without_rejected


def test_ordered_thresholds_and_shared_weights():
    rng = np.random.default_rng(0)
    rows, grades = [], []
    for _ in range(1500):
        n = int(rng.integers(0, 7))
        rows.append(np.array(sorted({*rng.choice(6, n, replace=False), 6 + int(rng.integers(0, 20))}), np.int64))
        grades.append(0 if n < 2 else 1 if n < 4 else 2 if n < 6 else 3)
    model = fit(rows, np.array(grades), np.arange(26), steps=600)
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 3
    assert model.weights[:6].min() > 3 * np.abs(model.weights[6:]).max()
    eta = np.array([model.weights[r].sum() for r in rows])
    severity = model.at_least(eta).sum(axis=1)
    means = [severity[np.array(grades) == g].mean() for g in range(4)]
    assert means == sorted(means) and abs(means[3] - 3) < 0.4 and means[0] < 0.3
    assert np.mean(np.rint(severity) == grades) > 0.9


def objective(params, rows, grades, weight, features, l2):
    """Weighted log loss of the cumulative-link model and the penalty, from their definitions."""
    w, free = params[:features], params[features:]
    thresholds = [free[0]]
    for gap in free[1:]:
        thresholds.append(thresholds[-1] + np.exp(gap))
    loss = 0.0
    for row, grade, share in zip(rows, grades, weight, strict=True):
        eta = sum(w[f] for f in row)
        above = [1.0, *(1 / (1 + np.exp(t - eta)) for t in thresholds), 0.0]
        loss -= share * np.log(above[grade] - above[grade + 1])
    return loss / sum(weight) + l2 / 2 * float((w**2).sum())


def pattern_search(params, features, loss, step=1.0):
    """Least value by trying steps in every coordinate, weights not below 0; uses no gradient."""
    best = loss(params)
    while step > 1e-4:
        better = False
        for i in range(len(params)):
            for sign in (1, -1):
                tried = params.copy()
                tried[i] += sign * step
                if i < features:
                    tried[i] = max(0.0, tried[i])
                value = loss(tried)
                if value < best - 1e-12:
                    params, best, better = tried, value, True
        if not better:
            step /= 2
    return best


@pytest.mark.parametrize("seed, weighted", [(0, False), (1, True), (2, True)])
def test_fit_equals_an_independent_optimiser(seed, weighted):
    rng = np.random.default_rng(seed)
    features, l2 = 5, 1e-2
    rows = [np.flatnonzero(rng.random(features) < 0.4) for _ in range(120)]
    true = np.array([2.0, 1.0, 0.5, 0.0, -1.0])
    grades = np.array([int((true[r].sum() + rng.logistic() > np.array([1.0, 2.5])).sum()) for r in rows])
    weight = rng.uniform(0.2, 3, len(rows)) if weighted else np.ones(len(rows))
    model = fit(rows, grades, np.arange(features), weight, l2=l2, steps=3000, rate=0.05)

    def loss(params):
        return objective(params, rows, grades, weight, features, l2)

    free = np.concatenate([model.thresholds[:1], np.log(np.diff(model.thresholds))])
    fitted = loss(np.concatenate([model.weights, free]))
    least = pattern_search(np.array([0.5] * features + [0.0, 0.0]), features, loss)
    assert fitted == pytest.approx(least, rel=2e-3)
    assert model.weights.min() >= 0


@pytest.fixture
def corpus(spark, documents):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "zxqrst" + rng.choice("abcdef") * 3, "Nasty!"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return documents(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents(corpus):
    docs, labels = corpus
    model = train(docs, labels.filter("doc_id < 400"))
    got = {r.doc_id: r for r in score(docs, model).collect()}
    held = [i for i in got if i >= 400]
    right = sum(got[i].rejected == (i % 5 == 0) for i in held)
    assert right / len(held) > 0.97
    assert all(0 <= got[i].severity <= 2 and 0 <= got[i].p_toxic <= 1 for i in got)
    kept = without_rejected(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].rejected}


def test_the_sample_is_bounded_and_fits_agree(corpus):
    docs, labels = corpus
    first, second = (train(docs, labels, sample_rows=100) for _ in range(2))
    assert (first.features == second.features).all() and np.allclose(first.weights, second.weights)
    got = score(docs, first).collect()
    assert np.mean([r.rejected == (r.doc_id % 5 == 0) for r in got]) > 0.85


def test_rare_toxic_words(spark, documents):
    """Each toxic text has one word of fifty; a word has ten texts of 500, held-out ones not counted."""
    rng = random.Random(11)
    marks = [f"{a}{b}q" for a in "mnoprstuvw" for b in "aeiou"]
    rows = []
    for i in range(5500):
        words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(20)]
        rows.append((i, " ".join([*words, marks[i % 50]] if i < 600 else words)))
    labels = spark.createDataFrame([(i, 1, int(i < 500)) for i, _ in rows if not 500 <= i < 600], "doc_id long, quality int, toxic int")
    docs = documents(*rows)
    got = {r.doc_id for r in score(docs, train(docs, labels, sample_rows=1000)).filter("rejected").collect()}
    assert sum(i in got for i in range(500, 600)) >= 95
    assert sum(i in got for i in range(600, 5500)) <= 0.01 * 4900


def test_grades_of_their_own(corpus, spark):
    docs, labels = corpus
    graded = labels.selectExpr("doc_id", "if(doc_id % 5 = 0, 1 + doc_id % 3, 0) grade")
    model = train(docs, graded, grade_col="grade")
    assert len(model.thresholds) == 3


def test_odd_rows(odd, none, corpus, spark):
    docs, labels = corpus
    mixed = docs.union(odd)
    bad = spark.createDataFrame([(None, 1, 1), (1, 1, None), (5, 0, 0), (5, 0, 1), (10**9, 1, 1)], labels.schema)
    model = train(mixed, labels.union(bad))
    rows = score(odd, model).collect()
    assert len(rows) == odd.count() and not any(r.rejected for r in rows if r.doc_id in (0, 1, 2))
    assert score(none, model).count() == 0 and without_rejected(none, model).count() == 0
    for some in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("toxic = 1")):
        assert not any(r.rejected for r in score(docs, train(docs, some)).collect())
    assert Model(np.empty(0, np.int64), np.empty(0), np.array([40.0])).eta(np.array([3])) == 0
