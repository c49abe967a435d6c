"""Point-in-time joins: boundaries, expiry, ties, duplicates, hot keys."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.operators.asof import asof_join, one_row_per_instant
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def frames(spark, entities, features):
    e = spark.createDataFrame([(i, k, at(t)) for i, k, t in entities], "id bigint, k string, ts timestamp_ntz")
    f = spark.createDataFrame(
        [(k, at(t), c, v) for k, t, c, v in features], "k string, fts timestamp_ntz, created bigint, v bigint"
    )
    return e, f


def joined(spark, entities, features, **options):
    e, f = frames(spark, entities, features)
    out = asof_join(e, f, ["k"], "ts", "fts", ["v"], ["created"], **options)
    return {r["id"]: r["v"] for r in out.collect()}


def brute(entities, features, ttl=None, unmatched="null"):
    out = {}
    for i, k, t in entities:
        own = [f for f in features if f[0] == k]
        valid = [f for f in own if f[1] <= t and (not ttl or f[1] >= t - ttl)]
        if valid:
            out[i] = max(valid, key=lambda f: (f[1], f[2]))[3]
        elif unmatched == "null" or not own:
            out[i] = None
    return out


def test_equal_time_matches_and_future_does_not(spark):
    assert joined(spark, [(1, "a", 10), (2, "a", 9)], [("a", 10, 0, 7)]) == {1: 7, 2: None}


def test_no_feature_rows_survive_and_future_only_are_dropped(spark):
    entities = [(1, "a", 5), (2, "b", 5)]
    features = [("a", 6, 0, 1)]
    assert joined(spark, entities, features, unmatched="drop_expired") == {2: None}
    assert joined(spark, entities, features) == {1: None, 2: None}


def test_ttl_edge_is_inclusive(spark):
    features = [("a", 0, 0, 1)]
    ttl = timedelta(seconds=10)
    e, f = frames(spark, [], features)
    e = spark.createDataFrame(
        [(1, "a", at(10)), (2, "a", at(10) + timedelta(microseconds=1))], "id bigint, k string, ts timestamp_ntz"
    )
    out = asof_join(e, f, ["k"], "ts", "fts", ["v"], ["created"], ttl=ttl)
    assert {r["id"]: r["v"] for r in out.collect()} == {1: 1, 2: None}
    dropped = asof_join(e, f, ["k"], "ts", "fts", ["v"], ["created"], ttl=ttl, unmatched="drop_expired")
    assert [r["id"] for r in dropped.collect()] == [1]


def test_zero_ttl_means_none(spark):
    assert joined(spark, [(1, "a", 1000)], [("a", 0, 0, 1)], ttl=timedelta(0)) == {1: 1}


def test_later_created_wins_a_tie(spark):
    assert joined(spark, [(1, "a", 5)], [("a", 5, 2, 20), ("a", 5, 1, 10)]) == {1: 20}


def test_duplicate_entity_rows_are_kept_and_can_be_collapsed(spark):
    e, f = frames(spark, [(1, "a", 5), (2, "a", 5)], [("a", 1, 0, 3)])
    out = asof_join(e, f, ["k"], "ts", "fts", ["v"], ["created"])
    assert rows(out.select("id", "v")) == [(1, 3), (2, 3)]
    assert rows(one_row_per_instant(out, ["k"], "ts", ["id"]).select("id", "v")) == [(2, 3)]


def test_null_key_matches_null_key(spark):
    assert joined(spark, [(1, None, 5)], [(None, 1, 0, 3), ("a", 2, 0, 4)]) == {1: 3}


def test_null_feature_value_is_a_match(spark):
    assert joined(spark, [(1, "a", 5)], [("a", 1, 0, 3), ("a", 2, 0, None)]) == {1: None}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        joined(spark, [], [], unmatched="other")


def big_case(seed):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}"
    entities = [(i, key(), rng.randrange(2000)) for i in range(800)]
    # the hot key's features are few, so whole slices hold none
    features = [(k, t, c, v) for c, v in enumerate(range(700)) for k, t in [(key(), rng.randrange(2000))] if k != "hot" or v % 40 == 0]
    return entities, features


@pytest.mark.parametrize("unmatched", ["null", "drop_expired"])
@pytest.mark.parametrize("ttl", [None, 60])
def test_hot_keys_are_cut_without_changing_the_result(spark, unmatched, ttl):
    entities, features = big_case(3)
    want = brute(entities, features, ttl, unmatched)
    option = {"unmatched": unmatched, "ttl": timedelta(seconds=ttl) if ttl else None}
    assert joined(spark, entities, features, rows_per_slice=60, **option) == want
    assert joined(spark, entities, features, **option) == want


moments = st.integers(0, 30)
keys = st.sampled_from(["a", "b", None])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(keys, moments), min_size=1, max_size=25),
    st.lists(st.tuples(keys, moments), min_size=1, max_size=25),
    st.sampled_from([None, 4]),
)
def test_agrees_with_join_and_rank(spark, left, right, ttl):
    entities = [(i, k, t) for i, (k, t) in enumerate(left)]
    features = [(k, t, c, c) for c, (k, t) in enumerate(right)]
    e, f = frames(spark, entities, features)
    f2 = f.withColumnRenamed("k", "fk")
    valid = F.col("fts") <= F.col("ts")
    if ttl:
        valid = valid & (F.col("fts") >= F.col("ts") - F.lit(timedelta(seconds=ttl)))
    pairs = e.join(f2, F.col("k").eqNullSafe(F.col("fk")) & valid, "left")
    newest = Window.partitionBy("id").orderBy(F.desc("fts"), F.desc("created"))
    plan_a = pairs.withColumn("n", F.row_number().over(newest)).where("n = 1").select("id", "v")
    window = timedelta(seconds=ttl) if ttl else None
    plan_b = asof_join(e, f, ["k"], "ts", "fts", ["v"], ["created"], ttl=window).select("id", "v")
    assert rows(plan_a) == rows(plan_b)


@pytest.mark.parametrize("unmatched", ["null", "drop_expired"])
def test_a_hot_instant_is_cut_too(spark, unmatched):
    rng = random.Random(12)
    when = lambda: 50 if rng.random() < 0.5 else rng.randrange(100)
    entities = [(i, "hot" if i % 3 else "b", when()) for i in range(900)]
    features = [("hot", when(), c, c) for c in range(600)]
    want = brute(entities, features, None, unmatched)
    assert joined(spark, entities, features, rows_per_slice=30, unmatched=unmatched) == want


def test_many_views_in_one_pass(spark):
    from tablewright.operators.asof import AsOf, asof_views

    rng = random.Random(11)
    keys = ["a", "a", "a", "b", None]
    entities = [(i, rng.choice(keys), rng.randrange(60)) for i in range(150)]
    tables = [[(rng.choice(keys), rng.randrange(60), c, rng.randrange(1000)) for c in range(80)] for _ in range(3)]
    ttls = [None, 7, 0]
    e = spark.createDataFrame([(i, k, at(t)) for i, k, t in entities], "id bigint, k string, ts timestamp_ntz")
    views = []
    for j, (rows_, ttl) in enumerate(zip(tables, ttls)):
        f = spark.createDataFrame(
            [(k, at(t), str(c) if j == 1 else c, v) for k, t, c, v in rows_],
            f"k string, fts timestamp_ntz, created {'string' if j == 1 else 'bigint'}, v{j} bigint",
        )
        tie = () if j == 2 else ("created",)
        if j == 2:
            f = f.groupBy("k", "fts").agg(F.max("v2").alias("v2"))
        views.append(AsOf(f, "fts", (f"v{j}",), tie, None if ttl is None else timedelta(seconds=ttl)))
    wants = []
    for j, (rows_, ttl) in enumerate(zip(tables, ttls)):
        if j == 1:
            rows_ = [(k, t, str(c), v) for k, t, c, v in rows_]
        if j == 2:
            rows_ = [(k, t, v, v) for k, t, c, v in rows_]
        wants.append(brute(entities, rows_, ttl))
    for slices in (7, 1000, 10**6):
        out = asof_views(e, views, ["k"], "ts", rows_per_slice=slices).collect()
        assert len(out) == 150
        for r in out:
            assert (r["v0"], r["v1"], r["v2"]) == tuple(w[r["id"]] for w in wants)
    kept = {r["id"] for r in asof_views(e, views, ["k"], "ts", "drop_expired", rows_per_slice=20).collect()}
    drops = [brute(entities, [(k, t, str(c), v) for k, t, c, v in rows_] if j == 1 else rows_, ttl, "drop_expired")
             for j, (rows_, ttl) in enumerate(zip(tables, ttls))]
    assert kept == set.intersection(*[set(d) for d in drops])


def test_one_range_exchange_whatever_the_number_of_views(spark):
    from tablewright.operators.asof import AsOf, asof_views

    e, f = frames(spark, [(1, "a", 5)], [("a", 1, 0, 3)])
    views = [AsOf(f.withColumnRenamed("v", f"v{j}"), "fts", (f"v{j}",), ("created",)) for j in range(4)]
    out = asof_views(e, views, ["k"], "ts")
    assert out.first().asDict() == {"id": 1, "k": "a", "ts": at(5), "v0": 3, "v1": 3, "v2": 3, "v3": 3}
    # the match reads what one pass has staged: only the table of one row per partition is shuffled
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 0 and "SortMergeJoin" not in plan


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 8)), max_size=25),
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 8)), max_size=25),
    st.sampled_from([2, 5, 100]),
)
def test_partitions_of_any_size(spark, people, history, slices):
    entities = [(i, k, t) for i, (k, t) in enumerate(people)]
    features = [(k, t, c, 10 * c) for c, (k, t) in enumerate(history)]
    assert joined(spark, entities, features, rows_per_slice=slices) == brute(entities, features)
