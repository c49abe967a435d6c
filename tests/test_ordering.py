"""Per-key picks, numbering and moving frames."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tablewright.operators import ordering as o
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def test_pick_first_and_last_with_ties(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 4), ("a", 0, 9), (None, 3, 1)], "k string, t bigint, id bigint")
    assert rows(o.pick_per_key(df, ["k"], ["t", "id"], "first")) == [("a", 0, 9), (None, 3, 1)]
    assert rows(o.pick_per_key(df, ["k"], ["t", "id"], "last")) == [("a", 1, 5), (None, 3, 1)]


def test_latest_in_closed_range(spark):
    df = spark.createDataFrame([("a", T0 + timedelta(days=d), d) for d in range(5)], "k string, ts timestamp_ntz, v bigint")
    start, end = (F.lit(str(T0 + timedelta(days=d))).cast("timestamp_ntz") for d in (1, 3))
    assert [r["v"] for r in o.latest_per_key(df, ["k"], "ts", start=start, end=end).collect()] == [3]


def test_latest_artifact(spark):
    data = [
        ("p/run1/step/a/model.bin", T0),
        ("p/run2/step/b/model.bin", T0 + timedelta(hours=1)),
        ("p/run3/step/c/model.bin", T0 + timedelta(hours=1)),
        ("p/run4/step/d/model.bin", T0 + timedelta(hours=9)),
        ("p/run1/other/a/data.bin", T0),
        ("short", T0),
    ]
    df = spark.createDataFrame(data, "key string, modified timestamp_ntz")
    cutoff = F.lit(str(T0 + timedelta(hours=2))).cast("timestamp_ntz")
    got = {r["short_name"]: r["key"] for r in o.latest_artifact(df, cutoff).collect()}
    assert got == {"step/model.bin": "p/run3/step/c/model.bin", "other/data.bin": "p/run1/other/a/data.bin"}
    assert o.latest_artifact(df, cutoff, ["other/data.bin"]).count() == 1


def test_codes(spark):
    df = spark.createDataFrame([("z", 1), ("a", 2), (None, 0), ("z", 3)], "c string, t bigint")
    assert rows(o.first_seen_codes(df, "c", ["t"])) == [("a", 1), ("z", 0)]
    assert rows(o.sorted_codes(df, "c")) == [("a", 0), ("z", 1)]


def test_unique_times_shift_only_copies(spark):
    data = [(i, "a" if i < 30 else f"b{i}", T0) for i in range(40)]
    df = spark.createDataFrame(data, "id bigint, k string, ts timestamp_ntz")
    for limit in (7, 1000):
        out = {r["id"]: r["ts"] for r in o.unique_times(df, ["k"], "ts", ["id"], rows_per_slice=limit).collect()}
        assert out == {i: T0 + timedelta(microseconds=2 * i if i < 30 else 0) for i in range(40)}


def test_shift_by_position(spark):
    df = spark.createDataFrame([(i, T0) for i in range(100)], "id bigint, ts timestamp_ntz").repartition(3)
    for limit in (9, 1000):
        out = o.shift_by_position(df, "ts", ["id"], rows_per_slice=limit)
        assert {r["id"]: r["ts"] for r in out.collect()} == {i: T0 + timedelta(microseconds=2 * i) for i in range(100)}


def history(spark, n=1500):
    rng = random.Random(4)
    data = [(i, rng.choice(["m1", "m1", "m2"]), T0 + timedelta(seconds=rng.randrange(300)), float(rng.randrange(100))) for i in range(n)]
    return data, spark.createDataFrame(data, "id bigint, m string, ts timestamp_ntz, v double").repartition(4)


def test_identity_history_in_blocks(spark):
    data, df = history(spark)
    want = {}
    for m in ("m1", "m2"):
        own = sorted((t, i, v) for i, k, t, v in data if k == m)
        for n, (_, i, _) in enumerate(own):
            part = [v for _, _, v in own[max(0, n - 15) : n + 1]]
            want[i] = sum(part) / len(part)
    for limit in (7, 100, 5000):
        out = o.identity_history(df, ["m"], "v", "ts", "id", n=16, rows_per_slice=limit)
        assert {r["id"]: r["mean_value"] for r in out.collect()} == want


def test_identity_now(spark):
    data, df = history(spark)
    got = {r["m"]: (r["mean_value"], r["n"]) for r in o.identity_now(df, ["m"], "v", "ts", "id", n=50).collect()}
    for m in ("m1", "m2"):
        newest = [v for _, _, v in sorted((t, i, v) for i, k, t, v in data if k == m)[-50:]]
        assert got[m] == (sum(newest) / 50, 50)
