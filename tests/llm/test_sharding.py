from collections import Counter, defaultdict

import pytest

from tablewright.llm.sharding import Permutation, shard_documents, shard_rows


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 100, 101, 1000])
def test_permutation_and_its_inverse(n):
    p = Permutation(n, seed=3)
    assert sorted(p.at(x) for x in range(n)) == list(range(n))
    assert all(p.row_at(p.at(x)) == x for x in range(n))


@pytest.mark.parametrize("n", [1, 7, 50, 1023])
def test_column_agrees_with_the_single_row(spark, n):
    p = Permutation(n, seed=5)
    got = {r["id"]: r["y"] for r in spark.range(n).withColumn("y", p.column(spark, "id")).collect()}
    assert got == {x: p.at(x) for x in range(n)}


def test_seeds_give_other_orders_that_look_random():
    a, b = Permutation(500, 1), Permutation(500, 2)
    assert sum(a.at(x) == b.at(x) for x in range(500)) < 10
    runs = sum(a.at(x + 1) == a.at(x) + 1 for x in range(499))
    assert runs < 10


def test_messy_documents(messy):
    rows = shard_documents(messy, shards=4).collect()
    assert len(rows) == messy.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    none = [r for r in rows if r["size"] == 16]
    assert len(none) == 3 and all(r["text_crc32"] == 0 for r in none)


def test_place_does_not_depend_on_partitions(docs):
    a = {r["doc_id"]: (r["shard"], r["slot"]) for r in shard_documents(docs).collect()}
    b = {r["doc_id"]: (r["shard"], r["slot"]) for r in shard_documents(docs.repartition(5)).collect()}
    assert a == b
    p, ranked = Permutation(len(a)), sorted(a)
    assert all(a[d] == (p.at(i) % 40, p.at(i) // 40) for i, d in enumerate(ranked))


def test_clashing_columns_are_replaced_and_empty_stays_empty(messy, empty):
    out = shard_rows(messy, ["doc_id", "text"], 3)
    assert set(out.columns) == set(messy.columns)
    assert Counter(type(r["shard"]) for r in out.collect()) == {int: messy.count()}
    assert shard_documents(empty).count() == 0
