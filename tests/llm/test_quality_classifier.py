import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm.base import documents, labels, prepare
from tablewright.llm import quality_classifier
from tablewright.llm.quality_classifier import (
    LEVELS, TEACHES, WIDTHS, Handed, Logistic, Sums, clear_labels, co_train, cut_of, fitted, newton, pseudo_labels, score,
)

LARGER = "/root/testdata/sf0.01"


def test_scores_separate_documents_it_was_not_trained_on(spark):
    docs, known = documents(spark, LARGER), labels(spark, LARGER)
    training, other = known.where("doc_id % 2 = 0"), known.where("doc_id % 2 = 1")
    model = co_train(docs, training, rounds=2)
    rows = score(docs, model, ["doc_id"]).join(other, "doc_id").collect()
    good = [r["score"] >= 0.5 for r in rows if r["quality"] == 1]
    bad = [r["score"] >= 0.5 for r in rows if r["quality"] == 0]
    assert len(rows) > 150 and sum(good) >= 0.95 * len(good) and sum(bad) <= 0.5 * len(bad)  # from 180 labels, 29 of them bad


def test_labels_that_contradict_or_lack_do_not_count(spark):
    rows = [(1, 1), (1, 0), (2, 1), (2, 1), (3, None), (None, 1), (4, 0), (5, 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, quality int")
    assert {tuple(r) for r in clear_labels(df).collect()} == {(2, 1), (4, 0)}


@pytest.mark.parametrize("quality", [1, 0])
def test_one_class_is_a_constant(messy, spark, quality):
    known = messy.select("doc_id").distinct().withColumn("quality", F.lit(quality))
    rows = score(messy, co_train(messy, known, rounds=1)).collect()
    assert len(rows) == messy.count()
    assert all((r["score"] >= 0.5) == (quality == 1) for r in rows)


def test_messy_documents(messy, empty, spark):
    known = spark.createDataFrame([(i, i % 2) for i in range(1, 18)], "doc_id bigint, quality int")
    out = score(messy, co_train(messy, known, rounds=1, per_round=2))
    assert set(out.columns) == {*messy.columns, "content_logit", "metadata_logit", "score"}
    rows = out.collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
    nothing = spark.createDataFrame([], "doc_id bigint, quality int")
    assert score(empty, co_train(empty, nothing, rounds=1)).count() == 0


def test_every_unlabelled_row_can_teach(spark, monkeypatch):
    prepare(spark)
    rows = [(i, "word " * (30 + i % 7) + ("!" * 200 if i % 2 else "."), "en", "ab"[i % 2], 100 + i % 5) for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").repartition(5)
    known = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    looked_at, trained_on = [], []

    def summed(of_rows, size, of, real=quality_classifier._summed):
        total = real(of_rows, size, of)
        (looked_at if size == 1 + 4 * LEVELS else trained_on).append(total)
        return total

    monkeypatch.setattr(quality_classifier, "_summed", summed)
    model = co_train(docs, known, rounds=2)
    assert [t[0] for t in looked_at] == [29_940, 29_940]
    # two rounds, two classes, a fiftieth each; both views together in the first step of a fit
    both = [t for t in trained_on if len(t) == sum(Sums.size(w) for w in WIDTHS.values())][-1]
    assert all(abs(n - 4 * 599) < 400 for n in (both[0], both[Sums.size(WIDTHS["content"])]))
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in score(docs, model).collect()) > 29_900


def test_a_fit_in_parts_is_the_fit_of_all(spark):
    r = np.random.default_rng(3)
    x = np.column_stack([r.normal(size=(4000, 5)), np.ones(4000)])
    y = (r.random(4000) < 1 / (1 + np.exp(-(x[:, 0] * 2 - x[:, 1] + 0.3)))).astype(float)
    start = Logistic(np.zeros(6), 0.0)
    whole = fitted({"a": newton(start)}, lambda m: {"a": Sums.of(x, y, m["a"])})["a"]

    def parts(m):
        flat = sum(Sums.of(x[i : i + 700], y[i : i + 700], m["a"]).flat() for i in range(0, 4000, 700))
        return {"a": Sums.from_flat(flat, 6)}

    split = fitted({"a": newton(start)}, parts)["a"]
    assert np.allclose(whole.weights, split.weights, atol=1e-8) and whole.weights[5] == 0
    assert abs(whole.weights[0] - 2) < 0.3 and abs(whole.weights[1] + 1) < 0.3 and abs(whole.intercept - 0.3) < 0.2


def test_cuts_take_a_share_whatever_the_ties():
    assert cut_of(np.array([3, 0, 4]), 7) == (-1, 0.0) and cut_of(np.array([3, 0, 4]), 5) == (0, 1 / 3)
    assert cut_of(np.array([3, 0, 4]), 4) == (0, 0.0) and cut_of(np.array([3, 0, 4]), 2) == (2, 0.5)
    n = 50_000
    marks = np.random.default_rng(1).integers(0, 2**63, n).astype(np.uint64)
    views = {v: np.ones((n, 1)) for v in TEACHES}  # all alike
    models = {v: Logistic(np.array([5.0]), 0.0) for v in TEACHES}
    rounds = []
    for turn in range(3):
        free = np.isnan(pseudo_labels(views, marks, rounds)["content"]).sum()
        counts = np.zeros(LEVELS)
        counts[int(quality_classifier.levels(np.array([5.0]))[0])] = free
        cuts = {(v, 1): cut_of(counts, 1000) for v in TEACHES} | {(v, 0): (-1, 0.0) for v in TEACHES}
        rounds.append(Handed(models, cuts))
        given = pseudo_labels(views, marks, rounds)["content"]
        assert abs(np.nansum(given) - 1000 * (turn + 1)) < 150 and (~np.isnan(given)).sum() == np.nansum(given)
