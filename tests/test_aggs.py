"""Summaries, with gaps, constants and hot values."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import aggs
from tests.conftest import rows


def sample(spark, n=2000, seed=5):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        x = 7.5 if rng.random() < 0.35 else rng.gauss(0, 10)  # one value holds a third of the rows
        y = None if rng.random() < 0.1 else x * 2 + rng.random()
        z = float("nan") if rng.random() < 0.05 else float(rng.randrange(9))
        data.append((i, x, y, z, 1.0, rng.random() < 0.5, rng.choice(["a", "b", None])))
    names = ["id", "x", "y", "z", "one", "flag", "k"]
    df = spark.createDataFrame(data, "id bigint, x double, y double, z double, one double, flag boolean, k string")
    return pd.DataFrame(data, columns=names), df.repartition(4)


def test_describe_agrees_with_pandas(spark):
    frame, df = sample(spark)
    got = {r["column_name"]: r for r in aggs.describe(df).collect()}
    want = frame[["id", "x", "y", "z", "one"]].astype(float).describe().T
    assert set(got) == set(want.index)
    for name, r in got.items():
        for ours, theirs in [
            ("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
            ("p75", "75%"), ("max", "max"),
        ]:
            assert math.isclose(r[ours], want.loc[name, theirs], rel_tol=1e-9, abs_tol=1e-9), (name, ours)


def test_exact_quantiles_at_many_probabilities(spark):
    rng = random.Random(2)
    values = [rng.gauss(0, 1) for _ in range(20_000)] + [0.25] * 9000
    df = spark.createDataFrame([("c", v) for v in values], "k string, v double").repartition(6)
    probs = [0.0, 0.001, 0.25, 0.5, 0.6180339, 0.99, 1.0]
    got = {r["prob"]: r["quantile"] for r in aggs.exact_quantiles(df, ["v"], probs).collect()}
    for p in probs:
        assert math.isclose(got[p], float(np.quantile(values, p)), rel_tol=1e-9, abs_tol=1e-12), p


def test_exact_quantiles_of_few_values(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, None, None)], "a double, b double, c double")
    out = aggs.exact_quantiles(df, ["a", "b", "c"], [0.25, 0.5])
    assert rows(out) == [("a", 0.25, 1.25), ("a", 0.5, 1.5), ("b", 0.25, 5.0), ("b", 0.5, 5.0)]


@pytest.mark.parametrize("setting", [("SKETCH_WIDTH", 1e-6), ("BRACKET_ROWS", 30), ("SKETCH_SIZE", 16)])
def test_a_bracket_that_misses_or_is_too_wide_is_searched_again(spark, monkeypatch, setting):
    monkeypatch.setattr(aggs, *setting)
    values = [float(i * i) for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(8)
    probs = [0.1, 0.5, 0.77]
    got = {r["prob"]: r["quantile"] for r in aggs.exact_quantiles(df, ["v"], probs).collect()}
    assert all(math.isclose(got[p], float(np.quantile(values, p)), rel_tol=1e-12) for p in probs)


def test_correlation_agrees_with_pandas(spark):
    frame, df = sample(spark)
    cols = ["x", "y", "z", "one"]
    want = frame[cols].corr()
    for r in aggs.corr_matrix(df, cols).collect():
        expected = want.loc[r["x"], r["y"]]
        assert (r["r"] is None) == bool(np.isnan(expected))
        if r["r"] is not None:
            assert math.isclose(r["r"], expected, abs_tol=1e-9)
    target = [r["column_name"] for r in aggs.corr_target(df, cols, "x").collect()]
    assert target[:2] == ["x", "y"] and target[-1] == "one"


def test_group_mean_drops_missing_keys(spark):
    frame, df = sample(spark)
    got = {r["k"]: r for r in aggs.group_mean(df, ["k"], ["y", "z", "flag"]).collect()}
    want = frame.groupby("k")[["y", "z", "flag"]].mean()
    assert set(got) == {"a", "b"}
    for k, r in got.items():
        assert all(math.isclose(r[c], want.loc[k, c]) for c in ["y", "z", "flag"])


def test_confusion_matrix_has_every_declared_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (None, 1), (1, 9)], "actual bigint, predicted bigint")
    got = {(r["actual"], r["predicted"]): r["n"] for r in aggs.confusion_matrix(df, "actual", "predicted", [0, 1, 2]).collect()}
    assert len(got) == 11 and got[0, 0] == got[0, 1] == got[1, 1] == got[None, 1] == got[1, 9] == 1 and sum(got.values()) == 5
    sparse = aggs.confusion_matrix(df, "actual", "predicted").collect()
    assert len(sparse) == 5 and sum(r["n"] for r in sparse) == 5


def test_correlation_where_unpaired_rows_lie_far_off(spark):
    data = [(1e12 + i, None) for i in range(50)] + [(float(i), float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(data, "a double, b double")
    want = pd.DataFrame(data, columns=["a", "b"]).corr().loc["a", "b"]
    got = {(r["x"], r["y"]): r["r"] for r in aggs.corr_matrix(df, ["a", "b"]).collect()}
    assert math.isclose(got["a", "b"], want, rel_tol=1e-9) and got["a", "a"] == 1.0


def test_accuracy_precision_recall(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "t string, p string")
    assert aggs.accuracy(df, "t", "p").first()[0] == 0.5
    assert aggs.accuracy(df.limit(0), "t", "p").first()[0] is None
    got = {r["label"]: (r["precision"], r["recall"]) for r in aggs.precision_recall(df, "t", "p").collect()}
    assert got == {"a": (1.0, 0.5), "b": (1 / 3, 1.0), "c": (None, 0.0)}
    scored = spark.createDataFrame([(True, 0.9), (True, 0.2), (False, 0.8), (False, 0.5)], "t boolean, s double")
    assert tuple(aggs.binary_precision_recall(scored, F.col("t"), F.col("s")).first()) == (0.5, 0.5)


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] + [(None,)], "c string")
    assert rows(aggs.class_weights(df, "c")) == [("a", 3, 4 / 6), ("b", 1, 2.0)]
