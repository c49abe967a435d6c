"""Mini-batch training: gradients, one process against many tasks, and what is learnt."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import models as m
from tablewright.operators import training as t
from tablewright.sources.workspace import shared_root

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(9)
    rows = []
    for i in range(700):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows.append((i, a, b, c, 2 if a + b > 1.2 else 1 if c > 0.5 else 0))
    rows += [(900, None, 0.1, 0.1, 1), (901, 0.1, 0.1, 0.1, None), (902, float("nan"), 0.1, 0.1, 1)]
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double, y bigint").repartition(3, "id")


def shuffled(data, seed):
    rows = data.dropna().where("NOT isnan(a)").orderBy(F.xxhash64(F.col("id"), F.lit(seed)), "id").collect()
    return np.array([[r[c] for c in FEATURES] for r in rows]), np.array([r["y"] for r in rows])


def test_gradient_is_the_slope_of_the_loss():
    r = np.random.default_rng(1)
    weights = [w + 0.01 for w in t.initial([3, 5, 4], 2)]
    x, y = r.random((6, 3)), np.array([0, 1, 2, 3, 1, 0])
    found, total = t.gradient(weights, x, y)
    assert np.isclose(total, t.losses(t.forward(weights, x)[-1], y).sum())
    for k, w in enumerate(weights):
        for at in [0, w.size // 2, w.size - 1]:
            moved = [v.copy() for v in weights]
            moved[k].ravel()[at] += 1e-6
            slope = (t.losses(t.forward(moved, x)[-1], y).sum() - total) / 1e-6
            assert np.isclose(slope, found[k].ravel()[at], atol=1e-4)


@pytest.mark.parametrize("workers", [1, 4])
def test_tasks_together_do_what_one_process_does(data, workers):
    some = data.where("id < 90")  # a meeting of all tasks takes Spark about a second
    net = t.train_network(some, FEATURES, "y", 3, "id", epochs=2, hidden=(8, 6), batch=32, workers=workers)
    weights, losses = t.train_here(*shuffled(some, 42), 3, 2, 42, hidden=(8, 6), batch=32)
    assert np.allclose([h["loss"] for h in net.history], losses, rtol=1e-9)
    assert all(np.allclose(a, b, rtol=1e-6, atol=1e-9) for a, b in zip(net.weights, weights))


def test_one_task_is_one_process_however_often_it_would_talk(data):
    net = t.train_network(data, FEATURES, "y", 3, "id", epochs=2, hidden=(8, 6), workers=1, every=10)
    weights, losses = t.train_here(*shuffled(data, 42), 3, 2, 42, hidden=(8, 6))
    assert np.allclose([h["loss"] for h in net.history], losses, rtol=1e-9)
    assert all(np.allclose(a, b, rtol=1e-6, atol=1e-9) for a, b in zip(net.weights, weights))


def test_tasks_that_average_their_weights_learn_and_repeat(data):
    train = lambda: t.train_network(data, FEATURES, "y", 3, "id", epochs=4, hidden=(32, 16), workers=3, every=8, rate=1e-2)
    a, b = train(), train()
    assert a.history == b.history and all((x == y).all() for x, y in zip(a.weights, b.weights))
    assert a.history[-1]["loss"] < 0.9 * a.history[0]["loss"]


def test_learns_and_reports_every_epoch(data):
    train, test = data.where("id % 5 > 0"), data.where("id % 5 = 0").dropna()
    net = t.train_network(train, FEATURES, "y", 3, "id", epochs=12, validation=test, rate=5e-3, workers=1)
    assert [h["epoch"] for h in net.history] == list(range(1, 13))
    assert set(net.history[0]) == {"epoch", "loss", "val_loss", "val_accuracy", "val_precision", "val_recall"}
    assert net.history[-1]["loss"] < net.history[0]["loss"]
    scored = m.predict(test, m.foreign_scorer(net.loader(), FEATURES))
    hits = scored.where(F.col("predicted") == F.col("y")).count() / test.count()
    majority = test.groupBy("y").count().agg(F.max("count")).first()[0] / test.count()
    assert hits > majority + 0.2 and np.isclose(hits, net.history[-1]["val_accuracy"])


def test_empty_and_tiny_tables(spark, data):
    net = t.train_network(data.limit(0), FEATURES, "y", 3, "id", epochs=1, hidden=(4,))
    assert net.history[0]["loss"] is None
    net = t.train_network(data.where("id = 1"), FEATURES, "y", 3, "id", epochs=1, hidden=(4,), validation=data.limit(0))
    assert net.history[0]["val_accuracy"] is None and net.history[0]["loss"] > 0


def test_meetings_of_an_epoch_are_bounded(data, monkeypatch):
    """With more rows tasks meet no more often; every row still counts, and training repeats."""
    assert t.between_meetings(32 * 64 * 32, 32, 32) == 32  # what the tasks were told, while that makes few meetings
    for rows in (5_000_000, 30_000_000):
        assert -(-(-(-rows // 32)) // t.between_meetings(rows, 32, 32)) <= t.MEETINGS
    train = lambda every: t.train_network(data, FEATURES, "y", 3, "id", hidden=(8, 6), workers=2, every=every)
    seldom = train(4)
    monkeypatch.setattr(t, "MEETINGS", 3)  # 11 batches of a task
    often = train(2)
    assert often.history == seldom.history and all((x == y).all() for x, y in zip(often.weights, seldom.weights))


def test_a_task_by_itself_keeps_its_arrays_and_learns_the_same():
    """What a task learns from batches, the last one short, is the training of one process, to the bit while batches are whole."""
    r = np.random.default_rng(3)
    x, y = r.random((32 * 5 + 7, 3)), r.integers(0, 4, 32 * 5 + 7)
    learner = t.Learner(t.Adam(t.initial([3, 8, 16, 4], 1)))
    arrays, lost = [learner.weights, learner.first, learner.second], 0.0
    for at in range(0, len(y), 32):
        lost += learner.learn(x[at : at + 32], y[at : at + 32])
        if at == 32 * 4:
            whole, _ = t.train_here(x[:160], y[:160], 4, 1, 1, hidden=(8, 16))
            assert (learner.weights == np.concatenate([w.ravel() for w in whole])).all()
    weights, losses = t.train_here(x, y, 4, 1, 1, hidden=(8, 16))
    assert np.allclose(learner.weights, np.concatenate([w.ravel() for w in weights]), rtol=1e-9, atol=1e-12)
    assert np.isclose(lost / len(y), losses[0], rtol=1e-12) and learner.steps == 6
    assert all(a is b for a, b in zip(arrays, [learner.weights, learner.first, learner.second]))


def test_shuffled_rows_are_written_once(spark, data):
    root = f"{shared_root(spark)}/tablewright"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    t.train_network(data, FEATURES, "y", 3, "id", epochs=0, hidden=(4,), workers=2, every=4)
    assert [name.split("-")[0] for name in set(os.listdir(root)) - before] == ["ordered"]


def test_a_network_predicts_a_few_rows_at_a_time(monkeypatch):
    net = t.Network(("a", "b", "c"), t.initial([3, 8, 4], 1), ())
    x = np.random.default_rng(2).random((700, 3))
    seen, real = [], t.forward
    monkeypatch.setattr(t, "forward", lambda w, part: seen.append(len(part)) or real(w, part))
    assert np.allclose(net.probabilities(x), real(net.weights, x)[-1], rtol=1e-12) and max(seen) <= t.ROWS
    assert net.probabilities(x[:0]).shape == (0, 4)
