"""The factorization machine against spelled-out sums, and what calibration does."""

import numpy as np

from tablekit.llm import toxicity


def _rows(n=3_000, seed=3):
    """Documents of 20 terms of 400; rare ones with two of four marking terms are toxic."""
    numbers = np.random.default_rng(seed)
    labels = (numbers.random(n) < 0.1).astype(float)
    rows = []
    for toxic in labels:
        terms = numbers.choice(np.arange(100, 500), 20, replace=False)
        marks = numbers.choice(4, 2, replace=False) if toxic else numbers.choice(4, int(numbers.random() < 0.3), replace=False)
        rows.append(np.unique(np.append(terms, marks)))
    return rows, labels


def test_pair_sum_equals_spelled_out_pairs():
    rows, labels = _rows(400)
    model = toxicity.fit(rows, labels)
    model.vectors[:-1] = np.random.default_rng(1).normal(0, 1, model.vectors[:-1].shape)
    assert len(model.weights) > 3
    for row, score in zip(rows[:40], model.scores(rows[:40]), strict=True):
        places = model.place[row]
        logit = model.bias + sum(model.weights[p] for p in places)
        for i, p in enumerate(places):
            logit += sum(float(model.vectors[p] @ model.vectors[q]) for q in places[i + 1 :])
        assert abs(score - 1 / (1 + np.exp(-np.clip(logit, -50, 50)))) < 1e-9


def test_calibration_marks_few_others_and_finds_more():
    rows, labels = _rows()
    folds = np.arange(len(rows)) % toxicity.FOLDS
    sizes = [len(x) for x in rows]

    def counted(chosen):
        some = np.concatenate([x for x, c in zip(rows, chosen, strict=True) if c])
        held = np.bincount(some, minlength=1 << toxicity.BUCKET_BITS)
        toxic = np.bincount(some, np.repeat(labels[chosen], np.array(sizes)[chosen]), 1 << toxicity.BUCKET_BITS)
        return toxicity._counted(held, toxic, chosen.sum(), labels[chosen].sum())

    without = [counted(folds != f) for f in range(toxicity.FOLDS)]
    plain = toxicity.fit(rows, labels)
    model = toxicity.fit_calibrated(counted(np.ones(len(rows), bool)), rows, labels, folds, without)
    others, truth = _rows(seed=4)
    scores, before = model.scores(others), plain.scores(others)
    assert np.array_equal(np.argsort(scores, kind="stable"), np.argsort(before, kind="stable"))
    assert (scores[truth == 0] >= toxicity.TOXIC_FROM).mean() <= 0.02
    assert (scores[truth == 1] >= toxicity.TOXIC_FROM).mean() >= (before[truth == 1] >= toxicity.TOXIC_FROM).mean()


def test_calibration_with_one_label_or_too_few_rows():
    none = toxicity.fit_calibrated(np.empty(0, np.int64), [], np.empty(0), np.empty(0, int), [np.empty(0, np.int64)] * 5)
    assert none.scores([np.empty(0, np.int64)])[0] < 1e-6
    rows = [np.array([1, 2]), np.array([2, 3])]
    few = toxicity.fit_calibrated(np.array([1, 2]), rows, np.array([0.0, 1.0]), np.array([0, 1]), [np.array([1]), np.array([2])])
    assert np.isfinite(few.scores(rows)).all()


def test_a_repeated_id_is_fitted_once(spark):
    text = "good words only " * 5
    docs = spark.createDataFrame([(i % 40, f"{text} {i}", "x") for i in range(400)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels, sample_rows=30)
    scored = toxicity.score_toxicity(docs, model).collect()
    assert len(scored) == 400 and all(0 <= r.score <= 1 for r in scored)
