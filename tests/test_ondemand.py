"""Derived features: order, cycles, and the same values offline and online."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.features import FeatureView
from tablewright.operators.ondemand import Derived, OnDemandView, historical, online, plan
from tablewright.operators.online_index import IndexedOnlineTable
from tests.conftest import rows

T0 = datetime(2024, 1, 1)
D, S = T.DoubleType(), T.StringType()


def view(spark, name, seed, feature="v"):
    r = random.Random(seed)
    data = [(r.choice(["a", "b", "c", None]), T0 + timedelta(hours=r.randrange(200)), i, r.choice([1.0, 2.5, None])) for i in range(60)]
    source = spark.createDataFrame(data, f"k string, ts timestamp_ntz, id bigint, {feature} double")
    return FeatureView(name, ("k",), "ts", T.StructType([T.StructField(feature, D)]), source, created="id")


def chain():
    """Declared in an order that is not the one to compute in."""
    return OnDemandView(
        "made",
        (
            Derived("last", S, ("made:middle", "request:unit"), lambda m, u: F.concat(m.cast("string"), F.lit(" "), u)),
            Derived("middle", D, ("made:first", "two:v"), lambda f, v: f * 10 + F.coalesce(v, F.lit(0.0))),
            Derived("first", D, ("one:v",), lambda v: F.coalesce(v, F.lit(-1.0))),
            Derived("unused", D, ("three:v",), lambda v: v),
        ),
    )


REQUEST = T.StructType([T.StructField("unit", S)])


def wanted(spark, refs=("made:last", "made:first", "one:v")):
    views = [view(spark, n, i) for i, n in enumerate(["one", "two", "three"])]
    return plan(refs, views, [chain()], REQUEST)


def test_levels_follow_inputs_and_leave_out_the_rest(spark):
    p = wanted(spark)
    assert [[ref for ref, _ in level] for level in p.levels] == [["made:first"], ["made:middle"], ["made:last"]]
    assert [v.name for v, _ in p.stored] == ["one", "two"] and p.request == ("unit",)
    assert wanted(spark, ["one:v"]).levels == ()


def test_offline_equals_online_at_the_same_instant(spark):
    p = wanted(spark)
    late = T0 + timedelta(days=30)
    people = [(k, u) for k in ("a", "b", "c", "zz", None) for u in ("kg", None)] + [("a", "kg")]
    entities = spark.createDataFrame([(k, u, late) for k, u in people], "k string, unit string, at timestamp_ntz")
    tables = {}
    for v, _ in p.stored:
        tables[v.name] = IndexedOnlineTable(spark, v, rows_per_bucket=2)
        tables[v.name].materialize(T0, late)
    offline = historical(entities, p, "at").drop("at")
    served = online(spark.createDataFrame(people, "k string, unit string"), p, tables)
    assert offline.columns == served.columns == ["k", "unit", "last", "first", "v"]
    assert rows(offline) == rows(served) and offline.count() == len(people)
    assert {r["first"] for r in served.collect() if r["k"] == "zz"} == {-1.0}


def test_historical_values_by_hand(spark):
    v = spark.createDataFrame([("a", T0, 0, 2.0), ("a", T0 + timedelta(hours=2), 1, 4.0)], "k string, ts timestamp_ntz, id bigint, v double")
    one = FeatureView("one", ("k",), "ts", T.StructType([T.StructField("v", D)]), v, created="id")
    made = OnDemandView("made", (Derived("x", T.IntegerType(), ("one:v", "request:unit"), lambda a, u: a * u.cast("double")),))
    e = spark.createDataFrame([("a", T0 + timedelta(hours=h), u) for h, u in ((0, "3"), (1, "5"), (2, "7"), (3, None))], "k string, at timestamp_ntz, unit string")
    got = historical(e, plan(["made:x"], [one], [made], REQUEST), "at").orderBy("at").collect()
    assert [r["x"] for r in got] == [6, 10, 28, None] and got[0]["unit"] == "3"


def test_declarations_that_cannot_work(spark):
    one = view(spark, "one", 0)
    loop = OnDemandView("x", tuple(Derived(n, D, (i,), lambda c: c) for n, i in (("a", "x:b"), ("b", "x:c"), ("c", "x:a"))))
    with pytest.raises(ValueError, match="x:a -> x:b -> x:c -> x:a"):
        plan(["x:a"], [one], [loop])
    with pytest.raises(ValueError, match="unknown feature reference 'one:w', an input of y:a"):
        plan(["y:a"], [one], [OnDemandView("y", (Derived("a", D, ("one:w",), lambda c: c),))])
    with pytest.raises(ValueError, match="request:unit"):
        plan(["request:unit"], [one])
    twice = Derived("a", D, (), lambda: F.lit(1.0))
    with pytest.raises(ValueError, match="declared twice"):
        plan(["y:a"], [one], [OnDemandView("y", (twice, Derived("a", D, (), lambda: F.lit(2.0))))])
    with pytest.raises(ValueError, match="taken"):
        plan(["one:v"], [one], [OnDemandView("one", ())])
    with pytest.raises(ValueError, match="same name"):
        plan(["one:v", "two:v"], [one, view(spark, "two", 1)])
    e = spark.createDataFrame([("a", T0)], "k string, at timestamp_ntz")
    made = OnDemandView("made", (Derived("x", D, ("request:unit",), lambda u: u),))
    with pytest.raises(ValueError, match="lacks"):
        historical(e, plan(["made:x"], [one], [made], REQUEST), "at")
    with pytest.raises(ValueError, match="already present"):
        historical(e.withColumn("v", F.lit(1)), plan(["one:v"], [one]), "at")
