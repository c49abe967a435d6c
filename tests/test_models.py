"""Training repeats, explanations add up, proposals reach their goal."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector  # noqa: F401  (import check)
from pyspark.sql import functions as F

from tablewright.operators import counterfactual as cf
from tablewright.operators import models as m

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(9)
    rows_ = []
    for i in range(400):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows_.append((i, a, b, c, float(2 if a + b > 1.2 else 1 if c > 0.5 else 0)))
    return spark.createDataFrame(rows_, "id bigint, a double, b double, c double, y double").repartition(3, "id")


@pytest.fixture(scope="module")
def logistic(data):
    return m.train_logistic(data, FEATURES, "y")


def predict(frame_rows):
    x = np.array(frame_rows)
    z = np.stack([x @ [1.0, -2.0, 0.5], x @ [-1.0, 1.0, 1.0]], axis=1)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def load():
    return predict


def test_network_repeats_with_its_seed(data):
    first, second = (m.predict(data, m.scorer(m.train_network(data, FEATURES, "y", 3, iterations=1))) for _ in range(2))
    key = lambda r: r["id"]
    a, b = sorted(first.collect(), key=key), sorted(second.collect(), key=key)
    assert all(np.allclose(x["probabilities"], y["probabilities"]) for x, y in zip(a, b))
    assert all(len(x["probabilities"]) == 3 and math.isclose(sum(x["probabilities"]), 1.0, rel_tol=1e-9) for x in a)


def test_logistic_learns(data, logistic):
    scored = m.predict(data, m.scorer(logistic))
    hits = scored.where(F.col("predicted") == F.col("y")).count()
    assert hits > 320


def test_attribution_adds_up(data, logistic):
    score = m.scorer(logistic)
    sample = m.background_sample(data, ["id"], FEATURES, n=30)
    out = m.feature_attribution(data, "id", FEATURES, score, sample, 3)
    sums, base = defaultdict(float), {}
    for r in out.collect():
        sums[r["id"], r["class_index"]] += r["contribution"]
        base[r["class_index"]] = r["base_value"]
    f_x = {r["id"]: r["probabilities"] for r in score(data).collect()}
    f_b = np.array([r["probabilities"] for r in score(sample).collect()]).mean(axis=0)
    assert np.allclose([base[k] for k in range(3)], f_b)
    assert len(sums) == 400 * 3
    assert all(math.isclose(s, f_x[i][k] - f_b[k], abs_tol=1e-9) for (i, k), s in sums.items())


@pytest.mark.parametrize("kind", ["attribution", "search"])
def test_points_of_a_table_in_one_part_are_scored_by_many_tasks(spark, data, kind, monkeypatch):
    """How many tasks score follows from the points, not from the files that the rows lie in."""
    seen = []

    def score(df):
        seen.append(df.rdd.getNumPartitions())
        return df.withColumn("probabilities", F.array(1 - F.col("a"), F.col("a")))

    monkeypatch.setattr(m, "POINTS_PER_TASK", 3000)
    few = data.where("id < 100").coalesce(1)
    if kind == "attribution":
        points = 100 * 30 * (len(FEATURES) + 1)
        out = m.feature_attribution(few, "id", FEATURES, score, m.background_sample(data, ["id"], FEATURES, n=30), 2)
    else:
        points = 100 * (m.STEPS + 1)
        out = m.counterfactual_search(few, "id", FEATURES, score, class_index=1)
    assert seen == [-(-points // 3000)]
    assert out.select("id").distinct().count() == 100


def test_attribution_of_an_unused_feature_is_zero(spark, data):
    def only_a():
        return lambda x: np.stack([1 - x[:, 0], x[:, 0]], axis=1)

    score = m.foreign_scorer(only_a, FEATURES)
    sample = m.background_sample(data, ["id"], FEATURES, n=10)
    out = m.feature_attribution(data.where("id < 20"), "id", FEATURES, score, sample, 2).collect()
    assert all(abs(r["contribution"]) < 1e-9 for r in out if r["feature"] != "a")
    mean_a = np.mean([r["a"] for r in sample.collect()])
    assert all(
        math.isclose(r["contribution"], r["value"] - mean_a, abs_tol=1e-6)
        for r in out if r["feature"] == "a" and r["class_index"] == 1
    )


def test_counterfactuals_reach_the_threshold(spark, data, logistic):
    score = m.scorer(logistic)
    out = m.counterfactual_search(data, "id", FEATURES, score, class_index=2, threshold=0.5)
    by_id = defaultdict(dict)
    for r in out.collect():
        by_id[r["id"]][r["feature"]] = r
    assert len(by_id) == 400
    before = {r["id"]: r["probabilities"][2] for r in score(data).collect()}
    proposed = [
        (i, *[float(f[c]["proposed"]) for c in FEATURES]) for i, f in by_id.items() if f["a"]["proposed"] is not None
    ]
    assert len(proposed) > 300
    after = score(spark.createDataFrame(proposed, "id bigint, a double, b double, c double"))
    assert all(r["probabilities"][2] >= 0.5 - 1e-9 for r in after.collect())
    for i, f in by_id.items():
        if before[i] >= 0.5:  # already there: nothing moves
            assert all(f[c]["difference"] == 0.0 for c in FEATURES)
        if f["a"]["proposed"] is not None:
            assert all(0.0 <= f[c]["proposed"] <= 1.0 for c in FEATURES)


def test_foreign_model(data):
    scored = m.foreign_scorer(load, FEATURES)(data.select("id", *FEATURES)).collect()
    x = np.array([[r[c] for c in FEATURES] for r in scored])
    assert np.allclose([r["probabilities"] for r in scored], predict(x), atol=1e-6)


def test_background_mean(spark):
    df = spark.createDataFrame([(i, float(i), 2.0) for i in range(300)], "id bigint, a double, b double")
    got = {r["feature"]: r["mean_background_value"] for r in m.background_mean(df, ["id"], ["a", "b"]).collect()}
    assert got == {"a": 49.5, "b": 2.0}


def linear(weights, features=FEATURES):
    def score(df):
        p = sum((F.col(c) * w for c, w in zip(features, weights)), F.lit(0.0))
        return df.withColumn("probabilities", F.array(1 - p, p))

    return score


def closed_form(x, weights, threshold):
    """The least sum of changes within [0, 1] that lifts a weighted sum to the threshold; None if none does."""
    missing, total = threshold - sum(a * w for a, w in zip(x, weights)), 0.0
    for a, w in sorted(zip(x, weights), key=lambda e: -abs(e[1])):
        room = (1 - a if w > 0 else a) * abs(w)
        take = min(max(missing, 0.0), room)
        total, missing = total + (take / abs(w) if w else 0.0), missing - take
    return total if missing <= 1e-12 else None


def distances(out):
    total, seen = defaultdict(float), {}
    for r in out.collect():
        seen[r["id"]] = r["proposed"] is not None
        total[r["id"]] += abs(r["difference"] or 0.0)
    return {i: total[i] if ok else None for i, ok in seen.items()}


@pytest.mark.parametrize("weights, threshold", [((0.25, 0.5, 0.25), 0.7), ((-0.3, 0.9, 0.2), 0.8), ((0.4, 0.4, 0.0), 0.9)])
def test_directed_search_finds_the_nearest_point_of_a_linear_rule(data, weights, threshold):
    some, score = data.where("id < 60"), linear(weights)
    got = distances(cf.nearest_counterfactual(some, "id", FEATURES, score, 1, threshold, rounds=4))
    random_draws = distances(m.counterfactual_search(some, "id", FEATURES, score, 1, threshold))
    for r in some.collect():
        want = closed_form([r[c] for c in FEATURES], weights, threshold)
        if want is None:
            assert got[r["id"]] is None
            continue
        assert want - 1e-9 <= got[r["id"]] <= want + 1e-3
        assert random_draws[r["id"]] is None or got[r["id"]] <= random_draws[r["id"]] + 1e-9


def test_directed_search_on_a_curved_model(spark, data, logistic):
    some, score = data.where("id < 60"), m.scorer(logistic)
    found = cf.nearest_counterfactual(some, "id", FEATURES, score, 2, 0.5, rounds=4)
    got, draws = distances(found), distances(m.counterfactual_search(some, "id", FEATURES, score, 2, 0.5))
    assert all(got[i] is not None and got[i] <= d + 1e-9 for i, d in draws.items() if d is not None)
    wide = found.groupBy("id").pivot("feature", FEATURES).agg(F.first("proposed")).dropna()
    assert wide.where("a < 0 OR a > 1 OR b < 0 OR b > 1 OR c < 0 OR c > 1").count() == 0
    assert all(r["probabilities"][2] >= 0.5 - 1e-9 for r in score(wide).collect())


def test_directed_search_of_rows_out_of_reach_repeated_and_incomplete(spark):
    rows = [(1, 0.0, 0.0, 0.0), (1, 0.0, 0.0, 0.0), (2, 1.0, 1.0, 1.0), (3, None, 0.5, 0.5)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double")
    got = distances(cf.nearest_counterfactual(df, "id", FEATURES, linear((0.2, 0.2, 0.2)), 1, 0.59, rounds=5))
    assert got[2] == 0.0 and got[3] is None and abs(got[1] - 2.95) < 1e-3
    assert distances(cf.nearest_counterfactual(df, "id", FEATURES, linear((0.1, 0.1, 0.1)), 1, 0.5, rounds=5)) == {1: None, 2: None, 3: None}
    assert cf.nearest_counterfactual(df.limit(0), "id", FEATURES, linear((1, 0, 0)), 1).collect() == []


def test_moving_back_stages_no_points(spark, data, monkeypatch):
    """Narrowing keeps a few numbers of each way, collects no arrays of points and moves them to no other task."""
    plans, stage = {}, cf.stage

    def seen(df, label="stage"):
        plans.setdefault(label, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, label)

    def score(df):
        p = 0.25 * F.col("a") + 0.75 * F.col("b")
        return df.withColumn("probabilities", F.array(1 - p, p))

    monkeypatch.setattr(cf, "stage", seen)
    found = cf.nearest_counterfactual(data.where("id < 40"), "id", FEATURES, score, 1, threshold=0.6, rounds=4)
    assert "ways" not in plans and all("collect_list" not in p for p in plans["back"])
    moved = defaultdict(float)
    for r in found.collect():
        moved[r["id"]] += abs(r["difference"])
    for r in data.where("id < 40").collect():
        rest = 0.6 - 0.25 * r["a"] - 0.75 * r["b"]
        first = min(max(rest, 0) / 0.75, 1 - r["b"])
        least = first + max(rest - 0.75 * first, 0) / 0.25
        assert least - 1e-9 <= moved[r["id"]] <= least + 1e-3
