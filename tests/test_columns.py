"""Row-level rules."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablewright.functions.payload import request, response, response_data
from tablewright.functions.scalars import allclose, argmax, metadata_map, path_part, version_stamp
from tablewright.operators import columns as c
from tests.conftest import rows


def test_lowercase_and_collision(spark):
    assert c.lowercase_columns(spark.range(1).toDF("ID")).columns == ["id"]
    with pytest.raises(ValueError):
        c.lowercase_columns(spark.createDataFrame([(1, 2)], "A int, b int").toDF("A", "a"))


def test_parse_date_strict_and_lenient(spark):
    df = spark.createDataFrame([("2023-12-20",), (None,)], "d string")
    assert rows(df.select(c.parse_date("d"))) == [(None,), (datetime(2023, 12, 20),)]
    bad = spark.createDataFrame([("20/12/2023",)], "d string")
    with pytest.raises(Exception):
        bad.select(c.parse_date("d")).collect()
    assert rows(bad.select(c.parse_date("d", strict=False))) == [(None,)]


def test_time_range_is_half_open(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "i int, t timestamp_ntz")
    out = c.in_time_range(df, "t", datetime(2024, 1, 1), datetime(2024, 1, 2))
    assert [r["i"] for r in out.collect()] == [1]


def test_ingest_time_and_stamp(spark):
    df = c.add_ingest_time(spark.range(1), datetime(2024, 5, 6, 7, 8, 9))
    assert df.select(version_stamp(F.col("event_timestamp"))).first()[0] == "2405060708"


def test_nan_becomes_null_and_dropna_takes_both(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "i int, v double")
    assert rows(c.nan_to_null(df)) == [(1, None), (2, None), (3, 1.0)]
    assert rows(df.dropna("any")) == [(3, 1.0)]


def test_replace_is_alike_for_short_and_long_mappings(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows(c.replace_values(df, "v", {"a": "x"})) == [("b",), ("x",), (None,)]
    many = {f"k{i}": str(i) for i in range(200)} | {"a": "x"}
    assert rows(c.replace_values(df, "v", many)) == [("b",), ("x",), (None,)]
    for mapping in ({"a": 1, None: 0}, {**{f"k{i}": i for i in range(200)}, "a": 1, None: 0}):
        out = c.replace_values(df, "v", mapping, to="int", unmapped="null")
        assert out.dtypes == [("v", "int")] and rows(out) == [(0,), (1,), (None,)]
        assert rows(c.replace_values(df, "v", mapping, to="int")) == [(0,), (1,), (None,)]
    numbers = spark.createDataFrame([(1,), (2,)], "v int")
    assert c.replace_values(numbers, "v", {1: 5}).dtypes == [("v", "int")]
    assert rows(c.replace_values(numbers, "v", {1: 5})) == [(2,), (5,)]


def test_validate(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (2, 50.0)], "id bigint, v double")
    rules = [c.Rule("v", not_null=True, low=0, high=10), c.Rule("id", unique=True)]
    assert rows(c.validate(df, rules)) == [("id", "unique", 1), ("v", "high", 1), ("v", "low", 0), ("v", "not_null", 1)]
    with pytest.raises(ValueError, match="v/high: 1"):
        c.require_valid(df, rules)
    c.require_valid(df, [c.Rule("id", not_null=True)])
    assert c.schema_violations(df, {"id": "bigint", "v": "float", "w": "int"}) == [
        "w: missing", "v: double instead of float",
    ]


def test_argmax_first_wins_and_close(spark):
    df = spark.createDataFrame([([0.1, 0.5, 0.5],)], "p array<double>")
    assert df.select(argmax(F.col("p"))).first()[0] == 1
    near = spark.createDataFrame([(1.0, 1.00001), (1.0, 1.1), (1.0, None)], "a double, b double")
    assert [r[0] for r in near.select(allclose(F.col("a"), F.col("b"))).collect()] == [True, False, False]


def test_path_parts(spark):
    df = spark.createDataFrame([("runs/7/step/13/model.bin",), ("x",)], "k string")
    assert rows(df.select(path_part(F.col("k"), -3), path_part(F.col("k"), -1))) == [("step", "model.bin"), (None, "x")]


def test_metadata_map(spark):
    extra = F.create_map(F.lit("b"), F.lit("new"))
    out = spark.range(1).select(metadata_map({"a": F.lit(1), "b": F.lit(2), "c": F.lit(3)}, extra, drop=["c"]))
    assert out.first()[0] == {"a": "1", "b": "new"}


def test_payload_round_trip(spark):
    df = spark.createDataFrame([(0.25, 1.0)], "duration double, tempo double")
    text = df.select(request(["duration", "tempo"])).first()[0]
    assert text == (
        '{"inputs":[{"name":"duration","shape":[1,1],"datatype":"FP32","data":[0.25]},'
        '{"name":"tempo","shape":[1,1],"datatype":"FP32","data":[1.0]}]}'
    )
    body = spark.createDataFrame([([0.1, 0.9],)], "p array<double>").select(response(F.col("p")).alias("b"))
    assert body.select(response_data(F.col("b"))).first()[0] == [0.1, 0.9]
    empty = spark.createDataFrame([('{"outputs":[]}',), ("{}",)], "b string")
    assert rows(empty.select(response_data(F.col("b")))) == [(None,), (None,)]
