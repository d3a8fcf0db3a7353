"""Toxicity and quality: held-out accuracy, what may be learned from, and defined corner cases."""

import random

import numpy as np
import pytest
from llm_support import by_id, docs, held

from layerwell.llm.quality import STATISTICS, isotonic, quality_report, statistics
from layerwell.llm.toxicity import Features, toxicity_report

LABELS = "doc_id long, quality int, toxic int"
BAD = ["blargor", "snivel", "grubber"]
ODD = [None, "", " ", "!!!", "🙂" * 50, "a" * 3_000_000, "word " * 100_000]


def corpus():
    random.seed(12)
    words = ["".join(random.choices("abcdefghiklmnoprst", k=random.randint(2, 8))) for _ in range(500)]
    rows, labels = [], []
    for i in range(900):
        text = random.choices(words, k=random.choice([15, 60, 200]))
        toxic, good = int(i % 6 == 0), int(i % 4 != 1)
        if toxic:
            for _ in range(3):
                text[random.randrange(len(text))] = random.choice(BAD) + random.choice(["", "s", "ing"])
        text = " ".join(text) if good else " ".join(w.upper() + "!!" for w in text)
        rows.append((i, text, "en", "s", 1, "x"))
        labels.append((i, good, toxic))
    rows += [(2000 + i, t, None, None, 1, None) for i, t in enumerate(ODD)]
    labels += [(2000, 1, None), (2001, None, 0), (None, 1, 1), (5000, 1, 1), labels[4]]
    return rows + [rows[8]], labels


EXTRA = ", label int, score string"


@pytest.mark.parametrize("report, column, least", [(toxicity_report, 2, 0.97), (quality_report, 1, 0.97)])
def test_held_out_accuracy_and_corner_cases(spark, report, column, least):
    rows, labels = corpus()
    threshold = 0.5 if column == 2 else 0.3
    got = report(docs(spark, rows, EXTRA), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) and r.held_out == held(r.doc_id, 5, 0) for r in got)
    truth = {r[0]: r[column] for r in labels if r[0] is not None and r[0] < 900}
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(tested) > 100 and sum(r.predicted == truth[r.doc_id] for r in tested) >= least * len(tested)
    again = {r.doc_id: r.score for r in report(docs(spark, rows, EXTRA), spark.createDataFrame(
        [(i, 1 - q if i is not None and q is not None and held(i, 5, 0) else q, 1 - t if i is not None and t is not None and held(i, 5, 0) else t) for i, q, t in labels], LABELS
    )).collect()}
    assert again == pytest.approx({r.doc_id: r.score for r in got}, abs=1e-9)  # held-out labels are not used


@pytest.mark.parametrize("report", [toxicity_report, quality_report])
def test_one_class_no_labels_and_no_rows(spark, report):
    rows = [(i, f"text {i}", "en", "s") for i in range(20)]
    labels = lambda value: spark.createDataFrame([(i, value, value) for i in range(20)], LABELS)
    none = spark.createDataFrame([], LABELS)
    assert {r.predicted for r in report(docs(spark, rows), labels(1)).collect()} == {1}
    assert {r.predicted for r in report(docs(spark, rows), labels(0)).collect()} == {0}
    assert len(report(docs(spark, rows), none).collect()) == 20
    assert report(docs(spark, []), labels(1)).collect() == []


def test_ngrams_are_distinct_characters_runs():
    features = Features()
    one = features.distinct("Foo bar")
    assert (one == features.distinct("foo  --bar!")).all() and len(features.distinct("")) == 0
    assert len(features.distinct("ab")) == 3  # " ab", "ab ", " ab "
    long = "lorem ipsum dolor " * 200_000  # longer than one stretch
    assert (features.distinct(long) == features.distinct("lorem ipsum dolor " * 3)).all()


def test_isotonic_equals_least_squares():
    rng = np.random.default_rng(2)
    counts = [(b, int(n), float(rng.integers(0, n + 1))) for b, n in enumerate(rng.integers(1, 9, 40))]
    at, share = isotonic(counts)
    assert (np.diff(share) >= -1e-12).all() and set(at) <= set(range(40))
    raw = np.array([g / n for _, n, g in counts])
    weight = np.array([n for _, n, _ in counts], float)
    best = [max(min(np.average(raw[i : j + 1], weights=weight[i : j + 1]) for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
    pooled = np.interp(np.arange(40), at, share)
    assert np.abs(pooled - best).max() < 1e-9


def test_statistics_are_finite():
    for text in ODD + ["\x00\x01", "\n\n\n", "A! B! C!"]:
        found = statistics(text)
        assert len(found) == len(STATISTICS) and np.isfinite(found).all()
    assert by_id is not None


def test_toxicity_counts_ratios_gradient_and_weights(spark):
    """Every n-gram takes part: counts, ratios, loss and gradient by plain sums over the labelled texts."""
    from layerwell.llm import toxicity

    random.seed(3)
    words = ["".join(random.choices("abcdefgh", k=4)) for _ in range(30)]
    texts = [
        (i % 2, " ".join([*random.choices(words, k=8), *(["marker"] if random.random() < (0.6 if i % 2 else 0.25) else [])]))
        for i in range(600)
    ]
    sample = spark.createDataFrame(texts, "label int, text string")
    rows = toxicity.sample_features(sample).cache()
    sets = [(label, set(Features().distinct(t).tolist())) for label, t in texts]
    counts = toxicity.feature_counts(rows).toPandas().set_index("bucket")
    for column, wanted in (("p", 1), ("q", 0)):
        assert {b: n for b, n in counts[column].items() if n} == {
            b: sum(b in s for x, s in sets if x == wanted) for b in set().union(*(s for x, s in sets if x == wanted))
        }
    telling = toxicity.telling_features(toxicity.feature_counts(rows), 300, 300).set_index("bucket")["ratio"]
    marker = Features().distinct("marker")
    assert len(marker) >= 14 and (telling[marker] > 0.3).all()  # a word of 60 and 25 percent keeps all its n-grams
    assert len(telling) < 0.1 * len(counts)
    for b, (p, q) in counts.iterrows():
        share = (p + q) / 600
        z = abs(p - q) / 300 / (share * (1 - share) / 150) ** 0.5 if share < 1 else 0
        want = np.log((p + 1) / (q + 1)) * (1 - 9 / z**2) if z > 3 else 0.0
        assert telling.get(b, 0.0) == pytest.approx(want, abs=1e-9)
    buckets, ratio = telling.index.to_numpy(), telling.to_numpy()
    known = toxicity.known_features(rows, buckets).cache()
    rng = np.random.default_rng(1)
    weights, constant = rng.normal(size=len(ratio)), 0.3
    loss, gradient = toxicity.loss_and_gradient(known, ratio, weights, constant)
    want, by_bucket, by_constant = toxicity.RIDGE / 2 * weights @ weights, toxicity.RIDGE * weights, 0.0
    for label, found in sets:
        at = np.flatnonzero(np.isin(buckets, list(found)))
        z = (weights[at] * ratio[at]).sum() + constant
        miss = 1 / (1 + np.exp(-z)) - label
        want += np.logaddexp(0, z) - label * z
        by_bucket[at] += miss * ratio[at]
        by_constant += miss
    assert loss == pytest.approx(want, rel=1e-5)
    assert gradient == pytest.approx(np.append(by_bucket, by_constant), abs=1e-3)
    best, free = toxicity._minimise(known, ratio)
    start, _ = toxicity.loss_and_gradient(known, ratio, np.zeros(len(ratio)), 0.0)
    end, left = toxicity.loss_and_gradient(known, ratio, best, free)
    assert end < start and np.abs(left).max() < 0.05 * len(texts)
    assert (best * ratio)[np.searchsorted(buckets, marker)].sum() > 0
