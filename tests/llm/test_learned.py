"""The two classifiers: held-out accuracy, segments against brute force, awkward rows."""

import random

import numpy as np
import pytest

from tidewater.llm import compression, toxicity
from tidewater.llm.common import small_batches, table
from tidewater.llm.fitting import logistic, probability

SF = "/root/testdata/sf0.1"


def held_out(scored, labels, column):
    got = scored.where("held_out").join(labels, "doc_id").select("predicted", column, "score").collect()
    right = np.array([r["predicted"] == r[column] for r in got])
    one = np.array([r[column] == 1 for r in got])
    return right[one].mean(), right[~one].mean(), len(got)


def test_toxicity_on_held_out_labels(spark):
    small_batches(spark)
    labels = table(spark, SF, "labels")
    toxic, clean, n = held_out(toxicity.op2_toxicity(table(spark, SF, "documents"), labels), labels, "toxic")
    assert n > 300 and toxic > 0.9 and clean > 0.98


def test_quality_on_held_out_labels(spark):
    small_batches(spark)
    labels = table(spark, SF, "labels")
    good, bad, n = held_out(compression.op5_compression_quality(table(spark, SF, "documents"), labels), labels, "quality")
    assert n > 300 and good > 0.97 and bad > 0.9


@pytest.mark.parametrize("op, column", [(toxicity.op2_toxicity, "toxic"), (compression.op5_compression_quality, "quality")])
def test_awkward_rows(spark, docs, rows, op, column):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    labels = [(i, k % 2, (k + 1) % 2, "x") for k, i in enumerate(ids)] + [(None, 1, 1, "x"), (ids[0], None, None, "x"), (99999, 1, 0, "x")]
    got = op(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] in (True, False) for r in got)
    none = op(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect()
    assert len({r["score"] for r in none}) == 1


def maximal(values):
    """All maximal scoring segments by definition: the best segment, then the same on either side (Ruzzo and Tompa)."""
    best = None
    for a in range(len(values)):
        total = 0.0
        for b in range(a, len(values)):
            total += values[b]
            if total > 0 and (best is None or total > best[2] + 1e-9 or (abs(total - best[2]) <= 1e-9 and b - a < best[1] - best[0] - 1)):
                best = (a, b + 1, total)
    if best is None:
        return []
    a, b, _ = best
    left = maximal(values[:a])
    right = [(s + b, e + b, v) for s, e, v in maximal(values[b:])]
    return [*left, best, *right]


def test_segments_against_the_definition():
    rng = random.Random(4)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c", b"x", b"x", b"x", b"x"]) for _ in range(rng.randrange(0, 40))]
        scores = {b"a": 1.13, b"b": 0.47, b"c": 2.71}
        got = toxicity.segments(words, toxicity.TokenScores(scores), 0.61)
        want = maximal([scores.get(w, -0.61) for w in words])
        assert [(s, e) for s, e, _ in got] == [(s, e) for s, e, _ in want]
        assert np.allclose([v for *_, v in got], [v for *_, v in want])


def test_calibration_root():
    values, shares = np.array([2.0, 3.0]), np.array([0.002, 0.001])
    lam = toxicity._lambda(values, shares, 0.1)
    assert abs((shares * np.exp(lam * values)).sum() + (1 - shares.sum()) * np.exp(-lam * 0.1) - 1) < 1e-9


def test_logistic_separates_and_survives_one_class():
    x = np.linspace(-3, 3, 200).reshape(-1, 1)
    y = (x[:, 0] > 0.5).astype(float)
    p = probability(logistic(x, y), x)
    assert ((p >= 0.5) == (y == 1)).mean() > 0.98
    assert np.isfinite(probability(logistic(x, np.ones(200)), x)).all()
    assert logistic(np.zeros((0, 1)), np.zeros(0)).tolist() == [0.0, 0.0]


def test_the_threshold_follows_from_learnable_rows(spark, monkeypatch):
    """Chosen from the grid by folds of the sample, the same in every run; a grid of one threshold is that threshold."""
    small_batches(spark)
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    chosen = []
    choose = toxicity._chosen_z
    monkeypatch.setattr(toxicity, "_chosen_z", lambda *a: chosen.append(choose(*a)) or chosen[-1])
    first = toxicity.fit(docs, labels)
    again = toxicity.fit(docs.repartition(5), labels)
    assert chosen[0] == chosen[1] and chosen[0] in toxicity.Z_GRID and first.scores.keys() == again.scores.keys()
    monkeypatch.setattr(toxicity, "Z_GRID", (chosen[0],))
    assert toxicity.fit(docs, labels).scores.keys() == first.scores.keys()
