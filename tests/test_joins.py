"""Equi-joins, lookups and set operations."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewright.operators.incremental import new_rows, upsert, upsert_unique
from tablewright.operators.joins import anti, decode, duplicate_keys, lookup, merge, require_unique
from tests.conftest import rows

# The columns of the two tables and of their left merge.
RANKINGS = [
    "spotify_id", "name", "artists", "popularity", "daily_rank", "daily_movement", "weekly_movement", "country",
    "snapshot_date", "album_name", "album_release_date",
]
PROPERTIES = [
    "spotify_id", "name", "artists", "snapshot_date", "is_explicit", "duration_ms", "danceability", "energy", "key",
    "loudness", "mode", "speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo",
    "time_signature",
]
MERGED = [
    "spotify_id", "name_x", "artists_x", "popularity", "daily_rank", "daily_movement", "weekly_movement", "country",
    "snapshot_date_x", "album_name", "album_release_date", "name_y", "artists_y", "snapshot_date_y", "is_explicit",
    "duration_ms", "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo", "time_signature",
]


def test_merged_columns_and_their_order(spark):
    left = spark.createDataFrame([], ", ".join(f"{c} string" for c in RANKINGS))
    right = spark.createDataFrame([], ", ".join(f"{c} string" for c in PROPERTIES))
    assert merge(left, right, "spotify_id").columns == MERGED


def test_merge_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "id bigint, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "id bigint, v string")
    assert rows(merge(left, right, "id")) == [(1, "a", "x"), (3, "c", None), (None, "b", "y")]
    assert rows(merge(left, right, "id", null_safe=False)) == [(1, "a", "x"), (3, "c", None), (None, "b", None)]
    assert rows(merge(left, right, "id", how="inner")) == [(1, "a", "x"), (None, "b", "y")]


def test_anti_with_null_in_the_list(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id bigint")
    right = spark.createDataFrame([(1,), (1,), (None,)], "id bigint")
    assert rows(anti(left, right, "id")) == [(2,)]
    assert rows(anti(left, right.where("id = 1"), "id")) == [(2,), (None,)]
    assert rows(anti(left, left, "id")) == []


def test_unique_keys_are_checked(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id bigint")
    assert rows(duplicate_keys(df, "id")) == [(1, 2)]
    with pytest.raises(ValueError):
        require_unique(df, "id")
    require_unique(df.distinct(), "id")


def test_lookup_keeps_misses_and_order(spark):
    stored = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, x bigint, y bigint")
    asked = spark.createDataFrame([("b",), ("z",), ("b",)], "k string")
    out = lookup(asked, stored, "k", ["y", "x"])
    assert out.columns == ["k", "y", "x"]
    assert rows(out) == [("b", 20, 2), ("b", 20, 2), ("z", None, None)]


def test_decode(spark):
    codes = spark.createDataFrame([("AR", 0), ("BR", 1)], "label string, code bigint")
    df = spark.createDataFrame([(1, 1), (2, 5)], "id bigint, c bigint")
    assert rows(decode(df, codes, "c", "country")) == [(1, 1, "BR"), (2, 5, None)]


def test_upsert_newest_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id bigint, v string")
    new = spark.createDataFrame([(2, "c", 1), (3, "d", 2), (None, "m", 3)], "id bigint, v string, extra bigint")
    want = [(1, "a", None), (2, "c", 1), (3, "d", 2), (None, "m", 3)]
    assert rows(upsert(old, new, ["id"])) == want
    assert rows(upsert_unique(old, new, ["id"]).select("id", "v", "extra")) == want


def test_upsert_orders_rows_of_one_source(spark):
    old = spark.createDataFrame([(1, 9, "old")], "id bigint, t bigint, v string")
    new = spark.createDataFrame([(1, 1, "first"), (1, 2, "second")], "id bigint, t bigint, v string")
    assert rows(upsert(old, new, ["id"], ["t"])) == [(1, 2, "second")]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=8),
    st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=8),
)
def test_upsert_is_idempotent(spark, a, b):
    old = spark.createDataFrame(list(a.items()), "id bigint, v bigint")
    new = spark.createDataFrame(list(b.items()), "id bigint, v bigint")
    once = upsert(old, new, ["id"])
    assert rows(once) == sorted(({**a, **b}).items(), key=repr)
    assert rows(upsert(once, new, ["id"])) == rows(once)


def test_new_rows(spark):
    current = spark.createDataFrame([(1,), (2,)], "id bigint")
    incoming = spark.createDataFrame([(2, "x"), (3, "y")], "id bigint, v string")
    assert rows(new_rows(current, incoming, ["id"])) == [(3, "y")]


def test_upsert_into_unique_table_does_not_shuffle_it(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    new = spark.createDataFrame([(2, 1, "c"), (2, 2, "d"), (3, 1, "e")], "id bigint, t bigint, v string")
    out = upsert(old, new, ["id"], ["t"], old_is_unique=True)
    assert rows(out.select("id", "v")) == [(1, "a"), (2, "d"), (3, "e")]
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        upsert(old, new, ["id"], old_is_unique=True)
