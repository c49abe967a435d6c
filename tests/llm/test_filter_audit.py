import random
import re
from collections import defaultdict
from itertools import permutations

from pyspark.sql import functions as F

from tablewright.llm.filter_audit import audit, coalition_counts, failures, potentials

LABELS = "doc_id bigint, quality int, toxic int, kept string"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [
        len(words) < 50, 100 * len(set(words)) < 65 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 5 * len(text), re.search(r"[#$%&*|]", text) is not None,
    ]


def brute(rows, labels):
    """The filters applied document by document in all 120 orders."""
    ids = defaultdict(list)
    for doc_id, text, source in rows:
        if doc_id is not None:
            ids[text or ""].append(doc_id)
    good = {d for d, q, *_ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, *_ in labels if t == 1 and d is not None}
    count, parts = defaultdict(int), {source or "" for *_, source in rows}
    for doc_id, text, source in rows:
        flags = dict(zip("ABCDE", [*fails(text or ""), doc_id is not None and min(ids[text or ""]) < doc_id]))
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                at = (source or "", order, step)
                count[*at, "unique_fails"] += flags[f] and sum(flags.values()) == 1
                if flags[f] and not gone:
                    gone = True
                    count[*at, "removed"] += 1
                    count[source or "", f, "shapley"] += 1
                    count[*at, "good_lost"] += doc_id in good
                    count[*at, "toxic_lost"] += doc_id in toxic
                elif flags[f]:
                    count[*at, "redundant"] += 1
                count[*at, "kept"] += not gone
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return sorted(
        (p, o, s, *(count[p, o, s, n] for n in names), count[p, o[s - 1], "shapley"])
        for p in parts for o in map("".join, permutations("ABCDE")) for s in range(1, 6)
    )


def random_rows(seed, n=120):
    r = random.Random(seed)
    texts = [None, "", " \n", "A B C", "x " * 300]
    for _ in range(30):
        words = [r.choice(["one", "Two", "THREE", "vier", "fünf", "#", "été"]) + str(r.randrange(80)) for _ in range(r.randrange(120))]
        texts.append(r.choice([" ", "\n", "  "]).join(words))
    rows = [(r.choice([i, i, i, 7, None]), r.choice(texts), r.choice(["a", "a", "b", None, ""])) for i in range(n)]
    labels = [(r.choice([i, None]), r.choice([0, 1, None]), r.choice([0, 1, None]), "z") for i in range(n) for _ in range(r.choice([0, 1, 2]))]
    return rows, labels


def test_equals_every_order_document_by_document(spark):
    rows, labels = random_rows(3)
    schema = "doc_id bigint, text string, source string, part string, mask string, good string, _id string"
    docs = spark.createDataFrame([(*x, "z", "z", "z", "z") for x in rows], schema).repartition(3)
    got = audit(failures(docs, spark.createDataFrame(labels, LABELS)))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, labels)


def test_shapley_values_add_up(spark, docs):
    none = spark.createDataFrame([], LABELS)
    rows = audit(failures(docs, none)).collect()
    lost, value = defaultdict(int), {}
    for r in rows:
        lost[r["part"], r["filter_order"]] += r["removed"]
        value[r["part"], r["filter_order"][r["step"] - 1]] = r["shapley"]
    for part in {r["part"] for r in rows}:
        assert {120 * n for (p, _), n in lost.items() if p == part} == {sum(v for (p, _), v in value.items() if p == part)}


def test_potential_of_a_known_game(spark):
    # gloves: 1 owns a left one, 2 and 3 right ones; the values are 2/3, 1/6, 1/6
    worth = [int(bool(s & 1 and s & 6)) for s in range(8)]
    q = spark.range(1).select(F.array(*[F.lit(w).cast("bigint") for w in worth]).alias("w")).select(potentials("w", 3)).first()[0]
    assert [q[7] - 3 * q[7 ^ 1 << i] for i in range(3)] == [4, 1, 1]


def test_coalitions_and_empty_tables(spark, empty):
    found = spark.createDataFrame([("a", 0b01, True, False), ("a", 0b11, False, True), ("a", 0, True, True)], "part string, mask int, good boolean, toxic boolean")
    assert coalition_counts(found, 2).first().asDict() == {
        "part": "a", "n_docs": 3, "removed": [0, 2, 1, 2], "good": [0, 1, 0, 1], "toxic": [0, 1, 1, 1],
    }
    none = spark.createDataFrame([], LABELS)
    assert audit(failures(empty, none)).collect() == []
