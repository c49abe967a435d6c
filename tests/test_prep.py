"""Encoding, splits, scaling, comparison, the training set."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablewright.operators import prep
from tablewright.operators.columns import Rule
from tablewright.plans.training import training_set
from tests.conftest import rows


def labelled(spark, n=1000, seed=3):
    rng = random.Random(seed)
    data = [(i, rng.choice(["hot", "hot", "a", "b", f"c{rng.randrange(6)}"]), rng.random() * 10) for i in range(n)]
    return data, spark.createDataFrame(data, "id bigint, y string, x double").repartition(4)


def hashed(i, seed=42):
    return hashlib.md5(f"{i}/{seed}".encode()).hexdigest()


def test_one_hot(spark):
    df = spark.createDataFrame([(0,), (2,)], "c bigint")
    assert rows(df.select(prep.one_hot(F.col("c"), 3))) == [([0.0, 0.0, 1.0],), ([1.0, 0.0, 0.0],)]


@pytest.mark.parametrize("limit", [50, 10_000])
@pytest.mark.parametrize("n", [1, 4, 5, 1001])
def test_split_ordered_sizes(spark, n, limit):
    df = spark.range(n).repartition(3)
    out = prep.split_ordered(df, ["id"], rows_per_slice=limit)
    test_ids = sorted(r["id"] for r in out.collect() if r["is_test"])
    n_test = -(-n * 20 // 100)
    assert test_ids == list(range(n - n_test, n))


@pytest.mark.parametrize("limit", [60, 10_000])
def test_split_is_disjoint_complete_and_stratified(spark, limit):
    data, df = labelled(spark)
    out = {r["id"]: r["split"] for r in prep.split(df, ["id"], "y", "id", rows_per_slice=limit).collect()}
    assert sorted(out) == [i for i, _, _ in data]
    assert [i for i, s in sorted(out.items()) if s == "test"] == list(range(800, 1000))
    groups = defaultdict(list)
    for i, y, _ in data[:800]:
        groups[y].append((hashed(i), i))
    for members in groups.values():
        taken = (len(members) * 20 + 50) // 100
        want = {i for _, i in sorted(members)[:taken]}
        assert {i for _, i in members if out[i] == "val"} == want


def test_shuffle_is_repeatable(spark):
    df = spark.range(200).repartition(5)
    order = [i for _, i in sorted((hashed(i), i) for i in range(200))]
    for limit in (30, 1000):
        out = {r["id"]: (r["position"], r["batch"]) for r in prep.shuffled(df, "id", rows_per_slice=limit).collect()}
        assert out == {i: (p, p // 32) for p, i in enumerate(order)}


def test_scaler_uses_train_rows_and_does_not_clip(spark):
    train = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0), (float("nan"), 5.0)], "a double, c double")
    fitted = prep.MinMax.fit(train, ["a", "c"])
    live = spark.createDataFrame([(20.0, 5.0), (-5.0, 7.0)], "a double, c double")
    assert rows(fitted.transform(live)) == [(-0.5, 2.0), (2.0, 0.0)]
    assert rows(fitted.inverse(fitted.transform(live))) == rows(live)
    assert rows(fitted.table(spark)) == [("a", 0.0, 10.0), ("c", 5.0, 5.0)]


def test_encode_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "y string")
    assert rows(prep.encode_labels(df, "y")) == [("a", 0), ("b", 1), (None, None)]


def test_compare_predictions(spark):
    a = spark.createDataFrame([(1, [0.5, 0.5]), (2, [1.0]), (3, [0.1])], "id bigint, p array<double>")
    b = spark.createDataFrame([(1, [0.500001, 0.6]), (2, [1.0]), (4, [0.2])], "id bigint, p array<double>")
    assert rows(prep.compare_predictions(a, b, ["id"], "p")) == [
        (1, 1, 0.5, 0.6), (3, 0, 0.1, None), (4, 0, None, 0.2),
    ]


def test_training_set(spark):
    rankings = spark.createDataFrame([(i, f"s{i % 9}", ["TR", "CH"][i % 2]) for i in range(100)], "id bigint, song string, country string")
    songs = spark.createDataFrame([(f"s{i}", float(i), None if i == 4 else i) for i in range(8)], "song string, tempo double, key bigint")
    made = training_set(
        rankings, songs, "song", "country", ["tempo", "key"], "id", [Rule("tempo", low=0, high=8)]
    )
    complete = [i for i in range(100) if i % 9 not in (4, 8)]
    got = {r["id"]: r for r in made.table.collect()}
    assert sorted(got) == complete
    assert rows(made.codes) == [("CH", 0), ("TR", 1)]
    train = [r["tempo"] for r in got.values() if r["split"] == "train"]
    assert min(train) == 0.0 and max(train) == 1.0
    n_test = -(-len(complete) * 20 // 100)
    assert [i for i in complete if got[i]["split"] == "test"] == complete[-n_test:]
    with pytest.raises(ValueError):
        training_set(rankings, songs, "song", "country", ["tempo"], "id", [Rule("tempo", high=2)])
