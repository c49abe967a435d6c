import random
from collections import Counter
from fractions import Fraction

import pytest

from tablewright.llm.mixing import mix, mixed_order, schedule, tempered


def fluid(blocks, weights, t):
    """Service of every source by time t, by following the rates."""
    had, now = [Fraction(0)] * len(blocks), Fraction(0)
    while now < t and any(h < n for h, n in zip(had, blocks)):
        live = [i for i in range(len(blocks)) if had[i] < blocks[i]]
        total = sum(weights[i] for i in live)
        step = min([t - now, *((blocks[i] - had[i]) * total / Fraction(weights[i]) for i in live)])
        for i in live:
            had[i] += step * Fraction(weights[i], total)
        now += step
    return had


@pytest.mark.parametrize("seed", range(25))
def test_no_source_is_a_block_off_its_fluid_share(seed):
    r = random.Random(seed)
    n = r.randrange(1, 7)
    blocks, weights = [r.randrange(0, 25) for _ in range(n)], [r.randrange(1, 40) for _ in range(n)]
    plan = schedule(blocks, weights)
    assert sorted((s, j) for s, j, *_ in plan) == [(s, j) for s in range(n) for j in range(blocks[s])]
    done = [0] * n
    for source, block, release, deadline, slot in plan:
        assert block == done[source] and release <= slot < deadline
        done[source] += 1
        assert all(abs(d - f) < 1 for d, f in zip(done, fluid(blocks, weights, slot + 1)))


def test_messy_documents(messy):
    out = mix(messy, "source", ["doc_id", "text"], blocks=8)
    rows = out.collect()
    assert sorted(r["position"] for r in rows) == list(range(messy.count()))
    sizes = Counter(r["source"] for r in messy.collect())
    assert Counter(r["source"] for r in rows) == sizes and None in sizes
    for s in sizes:
        assert sorted(r["source_row"] for r in rows if r["source"] == s) == list(range(sizes[s]))
    by_slot = sorted(rows, key=lambda r: r["position"])
    assert [r["slot"] for r in by_slot] == sorted(r["slot"] for r in rows)
    assert all(r["weight"] == tempered(sorted(sizes.items(), key=str))[r["source"]] for r in rows)


def test_weights_decide_and_must_be_positive(spark):
    df = spark.range(400).selectExpr("id AS doc_id", "if(id % 2 = 0, 'a', 'b') AS source")
    rows = sorted(mix(df, "source", ["doc_id"], {"a": 3, "b": 1}, blocks=400).collect(), key=lambda r: r["position"])
    for n in range(4, 260, 4):  # until a runs out, three of four are from a
        assert abs(sum(r["source"] == "a" for r in rows[:n]) - 3 * n / 4) < 1
    with pytest.raises(ValueError):
        mix(df, "source", ["doc_id"], {"a": 3})
    with pytest.raises(ValueError):
        mix(df, "source", ["doc_id"], max_sources=1)


def test_order_is_reproducible_and_empty_stays_empty(docs, messy, empty):
    a = {r["doc_id"]: r["position"] for r in mix(docs, "source", ["doc_id"]).collect()}
    b = {r["doc_id"]: r["position"] for r in mix(docs.repartition(4), "source", ["doc_id"]).collect()}
    assert a == b
    assert mix(empty, "source", ["doc_id"]).count() == 0
    order = mixed_order(docs, "source", ["doc_id"])
    assert order.columns == docs.columns
    assert [r["doc_id"] for r in order.collect()] == sorted(a, key=a.get)
    assert mixed_order(messy, "source", ["doc_id"]).count() == messy.count()
