import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tablewright.llm import ngram_join
from tablewright.llm.ngram_join import (
    Similarity,
    block_keys,
    fine_points,
    most_shared,
    most_shared_of_all,
    near_duplicates,
    overlaps,
    points,
    shingle_sets,
    without_near_duplicates,
)
from tablewright.llm.textbytes import slices
from tests.llm.conftest import words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def plain_components(texts, k, percent):
    """Of all pairs, by the definition; texts by their ids."""
    sets, root = {d: plain_set(t, k) for d, t in texts.items()}, {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(set)
    for d, s in sets.items():
        for g in s:
            holders[g].add(d)
    for a in sets:
        for b in {x for g in sets[a] for x in holders[g] if x > a}:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in texts}


def family(r, n, copies, edits):
    """A text and copies of it with some words changed."""
    base = [f"a{r.randrange(10**6)}" for _ in range(n)]
    out = [base]
    for _ in range(copies):
        c = list(r.choice(out))
        for _ in range(r.randrange(edits + 1)):
            c[r.randrange(len(c))] = f"b{r.randrange(10**6)}"
        out.append(c)
    return [" ".join(c) for c in out]


@pytest.mark.parametrize("like", [Similarity(3, 90), Similarity(5, 80), Similarity(1, 95), Similarity(2, 50)])
def test_linked_documents_share_a_key_and_pass_the_bound(like):
    r = random.Random(7)
    texts = [t for n in (3, 9, 12, 20, 33, 60, 150, 400) for t in family(r, n, 16, max(1, n // 60))]
    (part,) = slices(pa.array(texts))
    sets, where = shingle_sets(part, like.words)
    docs, keys = block_keys(sets, where, like, np.diff(where) > 0)
    held = defaultdict(set)
    for d, k in zip(docs.tolist(), keys.tolist()):
        held[d].add(k)
    point = points(sets, where).reshape(len(texts), -1)
    fine = fine_points(sets, where)
    own = [set(sets[a:b].tolist()) for a, b in zip(where, where[1:])]
    linked = 0
    for a, b in combinations(range(len(texts)), 2):
        both = len(own[a] & own[b])
        assert np.minimum(point[a], point[b]).sum() >= both and most_shared(fine[a], fine[b]) >= both
        if own[a] != own[b] and 100 * both >= like.percent * len(own[a] | own[b]):
            linked += 1
            assert held[a] & held[b], (texts[a], texts[b])
    assert linked > 30


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_components_of_all_pairs(spark, docs, k, percent):
    r = random.Random(k)
    texts = {x["doc_id"]: x["text"] for x in docs.collect()}
    for n, copies in ((40, 90), (150, 60), (10, 20), (2, 5)):  # 90 copies fill more than one leaf
        for t in family(r, n, copies, 2):
            texts[10_000 - len(texts)] = t
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_duplicates(df, "doc_id", "text", Similarity(k, percent)).collect()}
    assert got == plain_components(texts, k, percent)


def test_messy_documents(messy, empty):
    rows = near_duplicates(messy, "doc_id", "text").collect()
    assert len(rows) == messy.count()
    of = defaultdict(set)
    for r in rows:
        of[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert of[1] == of[2] == {(118, None)} and {c for _, c in of[9]} == {8}
    assert of[10] == {(1, 10)} and of[11] == {(1, 11)}
    assert all(of[i] == {(0, i)} for i in (4, 5, 6, 7))
    assert near_duplicates(empty, "doc_id", "text").count() == 0
    kept = without_near_duplicates(messy, "doc_id", "text")
    assert kept.columns == messy.columns
    rows = kept.collect()
    assert {r["text"] for r in rows} >= {words(5, 60), words(4, 90), None, ""} and sum(r["doc_id"] in (1, 2) for r in rows) == 0
    assert sum(r["text"] == words(3, 90) for r in rows) == 1
    assert without_near_duplicates(empty, "doc_id", "text").count() == 0


def test_links_are_counted(spark):
    r = random.Random(11)
    rows = []
    for n, copies in ((40, 70), (150, 40), (30, 30), (2, 5)):
        rows += family(r, n, copies, 2)
    rows += rows[:9] + rows[75:80] + ["", "   ", "one", "alone here"]  # equal sets, and none
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    sets = {d: plain_set(t, 3) for d, t in rows}
    wanted = dict.fromkeys(sets, 0)
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
            wanted[a] += 1
            wanted[b] += 1
    got = near_duplicates(df, "doc_id", "text").collect()
    assert {x["doc_id"]: x["n_links"] for x in got} == wanted and max(wanted.values()) > 10
    components = plain_components(dict(rows), 3, 90)
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == components


def test_overlaps_of_all_pairs(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 60, n).astype(np.uint64)) for n in (1, 5, 30, 60, 200, 3)]
    want = [[len(set(x.tolist()) & set(y.tolist())) for y in sets[:4]] for x in sets]
    assert overlaps(sets, sets[:4]).tolist() == want
    assert overlaps(sets[:1], [np.array([999], np.uint64)]).tolist() == [[0]]


def test_a_large_group_of_near_copies_makes_no_pairs_of_all(spark, monkeypatch):
    # each differs from the base by a few words of its own, so most of the pairs link
    r = random.Random(3)
    base = [f"a{r.randrange(10**6)}" for _ in range(400)]
    texts = []
    for i in range(300):
        c = list(base)
        c[r.randrange(len(c))] = f"b{i}"
        texts.append(" ".join(c))
    rows, plain = [], ngram_join.stage

    def counted(df, label="stage"):
        out = plain(df, label)
        rows.append((out.count(), label))
        return out

    monkeypatch.setattr(ngram_join, "stage", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = near_duplicates(df, "doc_id", "text").collect()
    assert {(x["component_id"], x["n_links"]) for x in got} == {(0, 299)}
    assert max(n for n, label in rows if label not in ("postings", "members")) <= 600, rows


def test_bounds_of_all_pairs():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 40, 60, 63, 200, 900)]
    sets = [np.unique(np.concatenate([x, sets[4][: i * 30]])) for i, x in enumerate(sets)]
    fine = fine_points(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    got = most_shared_of_all(fine, fine[:3])
    for i, j in np.ndindex(got.shape):
        assert got[i, j] >= most_shared(fine[i], fine[j]) >= len(np.intersect1d(sets[i], sets[j]))
    same = most_shared_of_all(fine[1:2], fine[1:2])
    assert same.tolist() == [[len(sets[1])]]
    full, half = bytes([255] * 16), bytes([255] + [3] * 15)  # 255 is that many or more
    assert (most_shared_of_all([full, half], [half])[:, 0] > 1 << 30).all() and most_shared_of_all([bytes([9] * 16)], [full]) == 144


def test_rows_of_shared_keys_across_batches():
    rows = [(1, 5), (2, 1), (2, 1), (2, 3), (2, 4), (2, 4), (3, 7), (3, 7), (4, 1), (4, 2), (5, 9)]
    for size in (1, 2, 3, 4, 11):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)] + [[]]
        batches = [pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in x], pa.int64()), "node": pa.array([n for _, n in x], pa.int64())}) for x in parts]
        got = [tuple(x.values()) for b in ngram_join._shared(batches) for x in b.to_pylist()]
        assert got == [(2, 1), (2, 3), (2, 4), (4, 1), (4, 2)]


def staged(monkeypatch):
    tables, plain = defaultdict(list), ngram_join.stage

    def kept(df, label="stage"):
        tables[label].append(plain(df, label))
        return tables[label][-1]

    monkeypatch.setattr(ngram_join, "stage", kept)
    return tables


def test_only_shared_keys_are_written(spark, monkeypatch):
    tables = staged(monkeypatch)
    texts = list(enumerate(t for i in range(40) for t in family(random.Random(i), 100, 0, 0)))
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    assert without_near_duplicates(df, "doc_id", "text").count() == 40
    assert all("keys" not in t.columns for of in tables.values() for t in of)
    assert tables["postings"][0].count() == 0


def test_a_passage_that_many_hold_does_not_send_their_texts_leaf_by_leaf(spark, monkeypatch):
    # three quarters of each text are the same, so they share keys, but only a few link
    tables = staged(monkeypatch)
    r = random.Random(5)
    passage = " ".join(f"a{r.randrange(10**6)}" for _ in range(300))
    texts = [passage + " " + " ".join(f"b{r.randrange(10**6)}" for _ in range(150)) for _ in range(150)]
    texts += [t + " end" for t in texts[:5]]
    read, plain = [], ngram_join._leaf_links
    monkeypatch.setattr(ngram_join, "_leaf_links", lambda *x: read.append(x) or plain(*x))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {x["doc_id"] for x in without_near_duplicates(df, "doc_id", "text", Similarity(5, 80)).collect()}
    assert got == set(range(150)) == {c for _, c in plain_components(dict(enumerate(texts)), 5, 80).values()}
    assert tables["open"][0].where("size > 16").count() > 300 and not read


def test_groups_near_the_threshold_are_verified_once(spark, monkeypatch):
    # many pairs that the points allow and the sets do not, in many keys at once
    tables = staged(monkeypatch)
    r = random.Random(6)
    base = [f"a{r.randrange(10**6)}" for _ in range(400)]
    texts = []
    for _ in range(120):
        c = list(base)
        for at in r.sample(range(8, 392, 8), 9):
            c[at] = f"b{r.randrange(10**6)}"
        texts.append(" ".join(c))
    monkeypatch.setattr(ngram_join, "TIE_LEAF", 32)
    monkeypatch.setattr(ngram_join, "MEET_LEAF", 32)
    monkeypatch.setattr(ngram_join, "BOUND_ROWS", 20)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    want = plain_components(dict(enumerate(texts)), 5, 80)
    got = {x["doc_id"] for x in without_near_duplicates(df, "doc_id", "text", Similarity(5, 80)).collect()}
    assert got == {c for _, c in want.values()}
    first, second = tables["candidates"]
    dense = second.where("b IS NULL").count()
    assert 0 < dense <= 120 * 4 and first.count() > second.count()
