"""The trained classifier against a plain numpy fit, and what its history and files hold."""

import hashlib
import math
import random

import numpy as np
import pytest

from precis.operators import classifier as cl
from precis.operators import evaluation
from precis.sources.storage import scratch_path

SCHEMA = "doc_id long, idx int, sentence string, label int, split string"
GOOD, BAD = ["sol", "mar", "cielo", "río"], ["ruido", "spam", "xx"]


def rows(n=120, noise=0.2):
    rng = random.Random(n)
    out = []
    for i in range(n):
        label = i % 2
        words = [rng.choice(GOOD if (rng.random() > noise) == bool(label) else BAD) for _ in range(rng.randrange(6))]
        out.append((i // 4, i % 4, " ".join(words) if words else None, label, "train" if i % 5 else "validation"))
    return [*out, (99, 0, "sol", 7, "train"), (99, 1, "sol", None, "train"), (99, 2, "mar mar", 1, None)]


def slot(word, slots):
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % slots


def plain_fit(data, slots, rule, rate, rounds):
    """Losses and accuracies of each round, and the weights, by dense matrices."""
    known = [r for r in data if r[3] in (0, 1)]
    x, y = np.zeros((len(known), slots + 1)), np.array([r[3] for r in known])
    for i, r in enumerate(known):
        words = (r[2] or "").split()
        for w in words:
            x[i, slot(w, slots)] += 1 / math.sqrt(len(words))
        x[i, slots] = 1
    train = np.array([r[4] == "train" for r in known])
    w, m, v, out = np.zeros(slots + 1), np.zeros(slots + 1), np.zeros(slots + 1), []
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-x @ w))
        g = x[train].T @ (p - y)[train] / train.sum()
        if rule == "sgd":
            w = w - rate * g
        elif rule == "rmsprop":
            v = 0.9 * v + 0.1 * g**2
            w = w - rate * g / (np.sqrt(v) + 1e-7)
        else:
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
            w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
        p = 1 / (1 + np.exp(-x @ w))
        loss, hit = -np.log(np.where(y == 1, p, 1 - p)), (p > 0.5) == (y == 1)
        out.append((loss[train].mean(), loss[~train].mean(), hit[train].mean(), hit[~train].mean()))
    return out, w


@pytest.mark.parametrize("rule, rate, few", [("adam", 0.05, 16), ("rmsprop", 0.02, 16), ("sgd", 0.5, 1)])
def test_fit_equals_numpy(spark, monkeypatch, rule, rate, few):
    # With few = 1 the partial sums are added by tasks first.
    monkeypatch.setattr(cl, "FEW", few)
    path, data = scratch_path(spark, "fit"), rows()
    table = spark.createDataFrame(data, SCHEMA).repartition(7)
    training = cl.Training(slots=64, rule=rule, rate=rate, rounds=6, min_delta=0.0)
    model = cl.train(table, path, training)
    expected, w = plain_fit(data, 64, rule, rate, 6)
    got = [tuple(r) for r in cl.history(spark, path).orderBy("epoch").collect()]
    assert [r[0] for r in got] == list(range(1, 7)) and {r[5] for r in got} == {rate}
    assert np.allclose([r[1:5] for r in got], expected, rtol=1e-9)
    # Both losses fall each round, so the last model is the best.
    assert all(a[1] > b[1] and a[2] > b[2] for a, b in zip(got, got[1:]))
    assert model.epoch == 6 and np.allclose(model.weights, w, rtol=1e-8)
    again = cl.Classifier.load(spark, path)
    assert again.epoch == 6 and np.array_equal(again.weights, model.weights)
    scores = {(r.doc_id, r.idx): r.score for r in again.score(table).collect()}
    for d, i, sentence, *_ in data:
        words = (sentence or "").split()
        z = w[-1] + sum(w[slot(x, 64)] for x in words) / math.sqrt(max(1, len(words)))
        assert abs(scores[d, i] - 1 / (1 + math.exp(-z))) < 1e-9


def test_early_stop_keeps_the_best(spark):
    """Validation rows that say the contrary: the loss rises from the first round on."""
    data = [(i, 0, "sol", 1, "train") for i in range(8)] + [(i, 1, "ruido", 0, "train") for i in range(8)]
    data += [(i, 2, "sol", 0, "validation") for i in range(4)] + [(i, 3, "ruido", 1, "validation") for i in range(4)]
    path = scratch_path(spark, "fit")
    model = cl.train(spark.createDataFrame(data, SCHEMA), path, cl.Training(slots=32, rounds=30, patience=4, rate_patience=2, rate=0.2))
    got = [tuple(r) for r in cl.history(spark, path).orderBy("epoch").collect()]
    assert len(got) == 5 and model.epoch == 1
    assert [r[5] for r in got] == [0.2, 0.2, 0.2, 0.1, 0.1]
    report = evaluation.training_report(cl.history(spark, path)).first()
    assert report.epochs == 5 and report.best_val_loss == got[0][2] and report.last_loss == got[-1][1]


def test_odd_tables(spark):
    data = [(1, 0, "a b", 1, "train"), (1, 1, "", 0, "train")]
    path = scratch_path(spark, "fit")
    model = cl.train(spark.createDataFrame(data, SCHEMA), path, cl.Training(slots=8, rounds=3, min_delta=0.0))
    assert model.epoch == 3
    assert [r.val_loss for r in cl.history(spark, path).collect()] == [None] * 3
    for some in (data[:0], [(1, 0, "a", 1, "validation")], [(1, 0, "a", None, "train")]):
        path = scratch_path(spark, "fit")
        model = cl.train(spark.createDataFrame(some, SCHEMA), path)
        assert model.epoch == 0 and not model.weights.any() and cl.history(spark, path).count() == 0
        assert not cl.Classifier.load(spark, path).weights.any()
    assert model.score(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.score for r in model.score(spark.createDataFrame([(None, 0, None, 0, "")], SCHEMA)).collect()] == [0.5]
    with pytest.raises(ValueError, match="unknown rule"):
        cl.train(spark.createDataFrame(data, SCHEMA), scratch_path(spark, "fit"), cl.Training(rule="newton"))
    with pytest.raises(Exception, match="(?i)already exists"):
        cl.train(spark.createDataFrame(data, SCHEMA), path)
