"""Ordered work on hot keys gives the same result as on ordinary ones."""

import random
from collections import Counter, defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from tablewright.operators.ranges import in_order
from tablewright.operators.slicing import rank_cutoffs, row_number
from tests.conftest import rows


def skewed(spark, n=3000, seed=1):
    """One key with a third of the rows, one null key, many small ones, repeated positions."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        u = rng.random()
        key = "hot" if u < 0.35 else None if u < 0.5 else f"k{rng.randrange(40)}"
        data.append((i, key, rng.randrange(500)))
    return data, spark.createDataFrame(data, "id bigint, k string, pos bigint").repartition(5)


def expected_numbers(data, keyed=True):
    groups = defaultdict(list)
    for i, k, p in data:
        groups[k if keyed else 0].append((p, i))
    return sorted(
        ((i, n) for g in groups.values() for n, (_, i) in enumerate(sorted(g), 1)), key=repr
    )


def test_partitions_follow_the_order_and_grow_with_the_rows(spark):
    data, df = skewed(spark)
    staged = in_order(df, ["k", "pos", "id"], rows_per_part=100)
    got = sorted((r["_part"], r["_pos"], r["k"] is not None, r["k"] or "", r["pos"], r["id"]) for r in staged.collect())
    assert [r[2:] for r in got] == sorted(r[2:] for r in got) and len(got) == len(data)
    sizes = Counter(r[0] for r in got)
    assert len(sizes) >= 25 and max(sizes.values()) < 300  # a hot key lies in many
    assert all(sorted(r[1] for r in got if r[0] == p) == list(range(n)) for p, n in sizes.items())


def test_any_orderable_type_in_any_place(spark):
    rng = random.Random(4)
    data = [(i, rng.choice([None, -1.5, 0.0, 2.25]), Decimal(rng.randrange(9)) / 4, "same prefix " * 9 + str(rng.randrange(99)))
            for i in range(700)]
    df = spark.createDataFrame(data, "id bigint, d double, m decimal(10,2), t string").repartition(5)
    for order in (["d", "id"], ["m", "t", "id"], ["t", "d", "m", "id"]):
        at = [["id", "d", "m", "t"].index(c) for c in order]
        want = sorted(data, key=lambda r: [(r[i] is not None, r[i]) if r[i] is not None else (False,) for i in at])
        out = row_number(df, [], order, rows_per_slice=60)
        assert rows(out.select("id", "row_number")) == sorted(((r[0], n) for n, r in enumerate(want, 1)), key=repr)


def test_row_number_per_key(spark):
    data, df = skewed(spark)
    order = ["pos", "id"]
    for limit in (150, 10_000):
        out = row_number(df, ["k"], order, rows_per_slice=limit)
        assert rows(out.select("id", "row_number")) == expected_numbers(data)


def test_row_number_of_the_whole_table(spark):
    data, df = skewed(spark)
    out = row_number(df, [], ["pos", "id"], rows_per_slice=100)
    assert rows(out.select("id", "row_number")) == expected_numbers(data, keyed=False)


def test_rank_cutoffs(spark):
    data, df = skewed(spark)
    for limit in (120, 10_000):
        found = rank_cutoffs(df, ["k"], ["pos", "id"], lambda n: F.floor(n / 5), rows_per_slice=limit)
        got = {r["k"]: (r["_cutoff"]["pos"], r["_cutoff"]["id"]) for r in found.collect()}
        groups = defaultdict(list)
        for i, k, p in data:
            groups[k].append((p, i))
        want = {k: sorted(g)[len(g) // 5 - 1] for k, g in groups.items() if len(g) >= 5}
        assert got == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "id bigint, k string, pos bigint")
    assert rows(row_number(df, ["k"], ["pos"])) == []
    assert rows(rank_cutoffs(df, ["k"], ["pos"], lambda n: n)) == []


def test_text_is_numbered_in_slices(spark):
    words = [f"w{i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(3)
    out = row_number(df, [], ["w"], rows_per_slice=60)
    assert rows(out) == [(w, n) for n, w in enumerate(sorted(words), 1)]


def test_one_position_with_most_rows(spark):
    rng = random.Random(11)
    days = [None if (u := rng.random()) < 0.3 else 7 if u < 0.7 else rng.randrange(20) for _ in range(2000)]
    data = [(i * 37 % 2000, "hot" if i % 3 else f"k{i % 50}", d) for i, d in enumerate(days)]
    df = spark.createDataFrame(data, "id bigint, k string, day bigint").repartition(4)
    limit = 40
    order = lambda r: (r[2] is not None, r[2] or 0, r[0])  # noqa: E731  (nulls first)
    groups = defaultdict(list)
    for r in data:
        groups[r[1]].append(r)
    want = sorted(((r[0], n) for g in groups.values() for n, r in enumerate(sorted(g, key=order), 1)), key=repr)
    out = row_number(df, ["k"], ["day", "id"], rows_per_slice=limit)
    assert rows(out.select("id", "row_number")) == want
    whole = row_number(df, [], ["day", "id"], rows_per_slice=limit)
    assert rows(whole.select("id", "row_number")) == sorted(
        ((r[0], n) for n, r in enumerate(sorted(data, key=order), 1)), key=repr
    )
    found = rank_cutoffs(df, ["k"], ["day", "id"], lambda n: F.ceil(n / 2), rows_per_slice=limit)
    got = {r["k"]: tuple(r["_cutoff"]) for r in found.collect()}
    assert got == {k: (lambda r: (r[2], r[0]))(sorted(g, key=order)[-(-len(g) // 2) - 1]) for k, g in groups.items()}


def test_number_of_small_parts_is_bounded(spark):
    """Parts below the least size are made while there are few of them, whatever is asked for; numbers stay right."""
    from tablewright.operators.ranges import FEW_PARTS, LEAST_ROWS, bounded_parts

    assert bounded_parts(1000, 25) == 40
    assert bounded_parts(6_000_000, 25) == FEW_PARTS
    assert bounded_parts(600 * LEAST_ROWS, 25) == 600
    assert bounded_parts(36_000_000, 1_000_000) == 36 and bounded_parts(0, 25) == 1
    df = spark.range(FEW_PARTS + 300).selectExpr("id % 3 AS k", "id")
    assert in_order(df, ["k", "id"], rows_per_part=1).agg(F.max("_part")).first()[0] < FEW_PARTS
    out = row_number(df, ["k"], ["id"], rows_per_slice=1).collect()
    assert {r["id"]: r["row_number"] for r in out} == {i: i // 3 + 1 for i in range(FEW_PARTS + 300)}
