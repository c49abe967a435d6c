"""Fingerprints, versions and the ETL jobs."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.columns import add_ingest_time
from tablewright.operators.features import FeatureService, FeatureView, OnlineTable, historical_features, service_from_refs
from tablewright.operators.versions import VersionedTable, diff, fingerprint
from tablewright.plans import etl
from tests.conftest import rows


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-5, 5), st.sampled_from(["x", "", None])), max_size=20), st.integers(1, 6))
def test_fingerprint_ignores_order_and_partitions(spark, data, parts):
    schema = "a bigint, b string"
    one = fingerprint(spark.createDataFrame(data, schema).coalesce(1)).first()
    other = fingerprint(spark.createDataFrame(data[::-1], schema).repartition(parts).select("b", "a")).first()
    assert one == other
    changed = fingerprint(spark.createDataFrame([*data, (9, "x")], schema)).first()
    assert changed["fingerprint"] != one["fingerprint"]


def test_fingerprint_sees_pairs_of_copies(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "a bigint")
    single = spark.createDataFrame([(1,)], "a bigint")
    assert fingerprint(df).first()["hash_xor"] == fingerprint(single).first()["hash_xor"]
    assert fingerprint(df).first()["fingerprint"] != fingerprint(single).first()["fingerprint"]


def test_write_read_revert(spark):
    a = spark.createDataFrame([(1, "x")], "id bigint, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z")], "id bigint, v string")
    stored = VersionedTable(spark).create(a, "a")
    assert stored.write(b, "b") == 2
    assert rows(stored.read(1)) == rows(a) and rows(stored.read()) == rows(b)
    assert stored.revert(1) == 3
    assert rows(stored.read()) == rows(a)
    marks = {r["version"]: r["fingerprint"] for r in stored.history().collect()}
    assert marks[1] == marks[3] != marks[2]
    assert marks[2] == fingerprint(b).first()["fingerprint"] == fingerprint(stored.read(2)).first()["fingerprint"]
    with pytest.raises(LookupError):
        stored.read(9)


def test_replace_reads_what_it_replaces(spark):
    stored = VersionedTable(spark).create(spark.range(10))
    stored.write(stored.read().where("id % 2 = 0"))
    stored.rename_column("id", "key")
    assert [r["key"] for r in stored.read().orderBy("key").collect()] == [0, 2, 4, 6, 8]


def test_failed_write_leaves_the_current_version(spark):
    stored = VersionedTable(spark).create(spark.range(3))
    with pytest.raises(Exception):
        stored.write(spark.range(3).select(F.raise_error(F.lit("stop")).cast("string").alias("id")))
    assert rows(stored.read()) == [(0,), (1,), (2,)]


def test_diff(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "id bigint, v string")
    b = spark.createDataFrame([(2, "Y"), (3, "z"), (None, "n")], "id bigint, v string")
    assert rows(diff(a, b, ["id"])) == [(1, "removed"), (2, "changed"), (3, "added")]
    assert rows(diff(a, a, ["id"])) == []


SCHEMA = T.StructType([T.StructField("v", T.FloatType())])
D1, D2, D3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def view(spark, data, **options):
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v double")
    return FeatureView("view", ("k",), "ts", SCHEMA, df, **options)


def test_view_is_checked(spark):
    assert dict(view(spark, []).table().dtypes) == {"k": "string", "ts": "timestamp_ntz", "v": "float"}
    with pytest.raises(ValueError):
        view(spark, []).table(["other"])
    with pytest.raises(ValueError):
        service_from_refs(["nowhere:v"], [view(spark, [])])


def test_two_views(spark):
    entities = spark.createDataFrame([(1, "a", D2), (2, "b", D2)], "id bigint, k string, ts timestamp_ntz")
    first = view(spark, [("a", D1, 1.0), ("a", D3, 3.0)])
    other = FeatureView(
        "other", ("k",), "at", T.StructType([T.StructField("w", T.LongType())]),
        spark.createDataFrame([("a", D2, 7), ("b", D3, 8)], "k string, at timestamp_ntz, w bigint"),
    )
    service = service_from_refs(["view:v", "other:w"], [first, other])
    assert service.features == ["v", "w"]
    out = historical_features(entities, service, "ts")
    assert rows(out.select("id", "v", "w")) == [(1, 1.0, 7), (2, None, None)]
    dropped = historical_features(entities, service, "ts", unmatched="drop_expired")
    assert rows(dropped.select("id", "v", "w")) == [(1, 1.0, 7)]


def test_materialize_then_incremental(spark):
    source = view(spark, [("a", D1, 1.0), ("a", D2, 2.0), ("b", D1, 5.0), ("c", D3, 9.0)])
    online = OnlineTable(spark, source)
    online.materialize(D1, D1)
    assert rows(online.read().select("k", "v")) == [("a", 1.0), ("b", 5.0)] and online.mark() == D1
    online.materialize_incremental(D3)
    assert rows(online.read().select("k", "v")) == [("a", 2.0), ("b", 5.0), ("c", 9.0)]
    assert online.mark() == D3
    before = rows(online.read())
    online.materialize_incremental(D3)
    assert rows(online.read()) == before
    asked = spark.createDataFrame([("c",), ("zz",)], "k string")
    assert rows(online.features(asked, FeatureService("s", ((source, ("v",)),)))) == [("c", 9.0), ("zz", None)]


def test_etl_load_and_refresh(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0)], "ID bigint, V double")
    new = spark.createDataFrame([(2, 20.0), (3, 30.0)], "ID bigint, V double")
    stored = VersionedTable(spark)
    etl.load(add_ingest_time(old, D1), stored)
    schema = T.StructType([T.StructField("v", T.DoubleType())])
    online = OnlineTable(spark, FeatureView("t", ("id",), "event_timestamp", schema, stored.read()))
    online.materialize(D1, D1)
    out = etl.refresh(stored, new, ["id"], D2, online)
    want = [(1, 1.0, D1), (2, 20.0, D2), (3, 30.0, D2)]
    assert rows(out.select("id", "v", "event_timestamp")) == want
    assert rows(online.read().select("id", "v", "event_timestamp")) == want
    etl.refresh(stored, new, ["id"], D2, online)
    assert rows(stored.read().select("id", "v", "event_timestamp")) == want


def test_marks_see_missing_values_and_maps(spark):
    a = spark.createDataFrame([(1, 7, None, {"x": 1, "y": None})], "id int, a int, b int, m map<string,int>")
    b = spark.createDataFrame([(1, None, 7, {"y": None, "x": 1})], "id int, a int, b int, m map<string,int>")
    c = spark.createDataFrame([(1, 7, None, {"y": 1, "x": None})], "id int, a int, b int, m map<string,int>")
    marks = {fingerprint(df).first()["fingerprint"] for df in (a, b, c)}
    assert len(marks) == 3
    assert rows(diff(a, b, ["id"])) == [(1, "changed")] and rows(diff(a, c, ["id"])) == [(1, "changed")]
    assert rows(diff(a, a.select("m", "b", "a", "id"), ["id"])) == []
    stored = VersionedTable(spark).create(a)
    assert stored.read().first()["m"] == {"x": 1, "y": None}
    stored.write(b)
    assert stored.read_mark(fingerprint(a).first()["fingerprint"]).first()["a"] == 7
    with pytest.raises(LookupError):
        stored.read_mark("none")


def test_every_write_gets_the_next_number(spark):
    df = spark.createDataFrame([(1,)], "id int")
    stored = VersionedTable(spark)
    assert [stored.write(df) for _ in range(3)] == [1, 2, 3]
    assert stored.newest() == 3 and VersionedTable(spark).newest() == 0
