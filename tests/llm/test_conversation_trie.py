import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tablewright.llm.conversation_trie import numbered_turns, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, k1 string, place string"


def brute(rows):
    """Every node by its definition, from whole prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, total = defaultdict(int), defaultdict(lambda: [0, 0])
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, who in members.items():
        for d in range(len(p) + 1):
            total[p[:d]][0] += kids[p] == 0
            total[p[:d]][1] += (len(who) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, who in members.items():
        done = ",".join(map(str, sorted(c for c in who if len(built[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(who), len(p), parent, len(who), kids[p], *total[p], hashlib.sha256(done.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def conversations(seed, n=60, deep=0):
    r = random.Random(seed)
    rows = []
    for c in [*range(n), *range(205, 205 + n // 2), 1000]:
        for turn in range(r.choice([1, 1, 2, 3, 6, 9])):
            text = r.choice(["a", "b", "", None, "Größe 🎉"]) if r.random() < 0.7 else f"own {c} {turn}"
            rows.append((r.choice([c, c, c, None]) if r.random() < 0.05 else c, turn or None, r.choice(["u", None, ""]), text))
    rows += [(2000 + k, t, "u", f"t{t}") for k in range(3) for t in range(deep + 10 * k)]
    r.shuffle(rows)
    return [(*x, "z", "z", "z") for x in rows]


@pytest.mark.parametrize("seed, height, deep", [(1, 16, 0), (2, 2, 40), (3, 3, 100)])
def test_equals_brute_force(spark, seed, height, deep):
    rows = conversations(seed, deep=deep)
    assert result(trie(spark.createDataFrame(rows, SCHEMA).repartition(3), height)) == brute(rows)


def test_a_conversation_over_many_partitions(spark):
    rows = [(7, t, "u", f"t{t % 5}", "z", "z", "z") for t in range(900)] + conversations(4, n=20)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    places = [r["place"] for r in numbered_turns(df, rows_per_part=100).where("conv_id = 7").collect()]
    own = sum(r[0] == 7 for r in rows)
    assert sorted(places) == list(range(1, own + 1))
    assert result(trie(df, rows_per_part=100)) == brute(rows)


def test_turnless_conversations_and_tied_copies(spark):
    # no first conversation of the family: what is short of h turns is empty and ends at the root
    rows = [(c, 0, "u", "same", "", "", "") for c in range(301, 340)]
    rows += [(500, 1, "u", "x", "", "", "")] * 4 + [(None, 1, "u", "x", "", "", "")] * 3
    got = result(trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256().hexdigest() for r in got)


def test_empty_table(spark):
    assert trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert trie(spark.createDataFrame([(None, 1, "u", "x", "", "", "")], SCHEMA)).collect() == []
