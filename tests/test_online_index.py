"""Indexed tables: the rows of a plain table, from the files of the request alone."""

import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators.incremental import upsert_unique
from tablewright.operators.joins import lookup
from tablewright.operators.online_index import IndexedTable, RangedTable
from tablewright.operators.versions import diff, fingerprint
from tests.conftest import rows

SCHEMA = "a bigint, b string, v double, w string"


def frame(spark, keys, seed=0):
    r = random.Random(seed)
    return spark.createDataFrame([(a, b, r.random(), r.choice(["x", None])) for a, b in keys], SCHEMA)


KEYS = [(i, b) for i in range(500) for b in ("p", None)] + [(None, "p"), (None, None)]


@pytest.fixture(scope="module")
def stored(spark):
    table = IndexedTable(spark, ["a", "b"], rows_per_bucket=20)
    table.write(frame(spark, KEYS))
    return table


def test_reads_and_fingerprint_of_a_plain_table(spark, stored):
    assert rows(stored.read()) == rows(frame(spark, KEYS))
    assert stored.entry()["fingerprint"] == fingerprint(frame(spark, KEYS)).first()["fingerprint"]
    assert stored.index().count() > 30 and stored.entry()["n_rows"] == len(KEYS)


def test_lookup_equals_the_plain_join(spark, stored):
    asked = spark.createDataFrame([(3, "p"), (3, None), (3, "p"), (None, None), (None, "q"), (9999, "p")], "a int, b string")
    got = stored.lookup(asked, ["w", "v"])
    want = lookup(asked.select(F.col("a").cast("bigint").alias("a"), "b"), frame(spark, KEYS), ["a", "b"], ["w", "v"])
    assert got.columns == ["a", "b", "w", "v"] and rows(got) == rows(want) and got.count() == 6


def test_a_request_opens_its_own_buckets(spark, stored):
    size = lambda df: len(df.inputFiles())
    everything = size(stored.read())
    one = stored.rows_for(spark.createDataFrame([(3, "p")], "a bigint, b string"))
    assert rows(one) == rows(frame(spark, KEYS).where("a = 3 AND b = 'p'"))
    held = [f for f in one.inputFiles() if "_bucket" in f]
    assert len(held) == 1 < everything
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_key_hash), EqualTo(_key_hash" in plan or "In(_key_hash" in plan
    many = stored.rows_for(frame(spark, KEYS).select("a", "b").where("a < 40"))
    assert many.count() == 80 and len([f for f in many.inputFiles() if "_bucket" in f]) <= everything


def test_upsert_rewrites_touched_buckets_and_refers_to_the_others(spark, stored):
    table = IndexedTable(spark, ["a", "b"], rows_per_bucket=20)
    table.write(frame(spark, KEYS))
    delta = frame(spark, [(7, "p"), (None, None), (100_000, "new")], seed=9)
    before = {r["bucket"]: r["file"] for r in table.index().collect()}
    table.upsert(delta)
    after = {r["bucket"]: r["file"] for r in table.index().collect()}
    assert sum(after[b] != before.get(b) for b in after) <= 3
    want = upsert_unique(frame(spark, KEYS), delta, ["a", "b"])
    assert rows(table.read()) == rows(want)
    assert table.entry()["fingerprint"] == fingerprint(want).first()["fingerprint"]
    assert rows(table.read(1)) == rows(frame(spark, KEYS))  # the version before is as it was


def test_changes_read_only_buckets_that_differ(spark):
    table = IndexedTable(spark, ["a", "b"], rows_per_bucket=20)
    table.write(frame(spark, KEYS))
    table.upsert(frame(spark, [(7, "p"), (100_000, "new")], seed=9))
    found = table.changes(1, 2)
    assert rows(found) == rows(diff(table.read(1), table.read(2), ["a", "b"]))
    assert len({f for f in found.inputFiles() if "_bucket" in f}) <= 4
    assert table.changes(2, 2).collect() == []


def test_a_table_that_outgrew_its_buckets_gets_new_ones(spark):
    table = IndexedTable(spark, ["a", "b"], rows_per_bucket=5)
    table.write(frame(spark, [(i, "p") for i in range(5)]))
    more = frame(spark, [(i, "p") for i in range(3, 90)], seed=4)
    table.upsert(more)
    assert table.index().agg(F.max("n_buckets")).first()[0] == 18
    assert rows(table.read()) == rows(upsert_unique(frame(spark, [(i, "p") for i in range(5)]), more, ["a", "b"]))


def test_empty_tables_and_requests(spark, stored):
    table = IndexedTable(spark, ["a", "b"])
    table.write(frame(spark, []))
    assert table.read().collect() == [] and table.entry()["fingerprint"] == fingerprint(frame(spark, [])).first()["fingerprint"]
    assert rows(table.lookup(frame(spark, [(1, "p")]), ["v"])) == [(1, "p", None)]
    assert stored.lookup(frame(spark, []), ["v"]).collect() == []
    table.upsert(frame(spark, [(1, "p")]))
    assert table.read().count() == 1
    with pytest.raises(ValueError):
        table.upsert(frame(spark, [(1, "p")]).drop("w"))


def test_ranges_changed_in_one_place_read_and_write_about_that_place(spark):
    keys = [(i, "p") for i in range(2000)] + [(None, "p")]
    table = RangedTable(spark, ["a", "b"], rows_per_bucket=100)
    table.write(frame(spark, keys))
    assert rows(table.read()) == rows(frame(spark, keys)) and table.index().count() > 12
    delta = frame(spark, [(i, "p") for i in range(700, 720)] + [(710, "new")], seed=3)
    table.upsert(delta)
    want = upsert_unique(frame(spark, keys), delta, ["a", "b"])
    assert rows(table.read()) == rows(want) and rows(table.read(1)) == rows(frame(spark, keys))
    assert table.entry()["fingerprint"] == fingerprint(want).first()["fingerprint"]
    before, after = ({r["bucket"]: r["file"] for r in table.index(table.entry(v)).collect()} for v in (1, 2))
    assert sum(before[b] != after[b] for b in before) <= 2
    found = table.changes(1, 2)
    assert rows(found) == rows(diff(table.read(1), table.read(2), ["a", "b"]))
    assert len({f for f in found.inputFiles() if "_bucket" in f}) <= 4
    asked = spark.createDataFrame([(705, "p"), (None, "p"), (-5, "p"), (9999, "p"), (710, "new")], "a bigint, b string")
    assert rows(table.lookup(asked, ["v"])) == rows(lookup(asked, want, ["a", "b"], ["v"]))
    assert len([f for f in table.rows_for(asked.limit(1)).inputFiles() if "_bucket" in f]) == 1


def test_ranges_of_texts_take_keys_outside_them(spark):
    def named(pairs):
        return spark.createDataFrame(pairs, "k string, v bigint")

    table = RangedTable(spark, ["k"], rows_per_bucket=10)
    table.write(named([(f"m{i:03d}", i) for i in range(60)]))
    more = named([("a", 1), ("zz", 2), (None, 3), ("m005", 4)])
    table.upsert(more)
    assert rows(table.read()) == rows(upsert_unique(named([(f"m{i:03d}", i) for i in range(60)]), more, ["k"]))
    table.upsert(named([("a", 9)]))
    assert rows(table.changes(2, 3)) == [("a", "changed")] and rows(table.changes(1, 3))[0][1] == "added"
    empty = RangedTable(spark, ["k"])
    empty.write(named([]))
    empty.upsert(named([("x", 1)]))
    assert rows(empty.read()) == [("x", 1)]


def test_number_of_buckets_is_bounded(spark):
    """Many rows in tiny buckets make no more than so many files; an upsert keeps them and the rows are right."""
    from tablewright.operators.ranges import FEW_PARTS

    rows = spark.range(FEW_PARTS + 100).selectExpr("id AS k", "id AS v")
    for kind in (IndexedTable, RangedTable):
        table = kind(spark, ["k"], rows_per_bucket=1)
        table.write(rows)
        assert table.index().count() <= FEW_PARTS
        table.upsert(spark.range(3).selectExpr("id AS k", "-1L AS v"))
        got = {r["k"]: r["v"] for r in table.read().collect()}
        assert got == {i: -1 if i < 3 else i for i in range(FEW_PARTS + 100)}
        assert sorted(tuple(r) for r in table.changes(1, 2).collect()) == [(i, "changed") for i in range(3)]
