import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tablewright.llm.exact_dedup import LEAST, MOST, _cut, exact_groups, without_copies
from tablewright.llm.textbytes import Texts


def cut(raw: bytes):
    return _cut(Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))[2]


def test_chunks_join_to_the_text_and_follow_content():
    raw = np.random.default_rng(1).integers(97, 123, 300_000).astype(np.uint8).tobytes()
    chunks = cut(raw)
    assert b"".join(chunks) == raw and max(map(len, chunks)) <= MOST
    assert all(len(c) >= LEAST for c in chunks[:-1])
    moved = cut(b"some bytes in front" + raw)
    assert len(set(chunks) & set(moved)) > 0.9 * len(chunks)
    same = cut(b"a" * 100_000)
    assert b"".join(same) == b"a" * 100_000


def test_messy_documents(messy):
    want = defaultdict(list)
    for r in messy.collect():
        want[r["text"] or ""].append(r["doc_id"])
    rows = exact_groups(messy, "doc_id", "text").collect()
    assert len(rows) == messy.count()
    assert sum(r["kept"] for r in rows) == len(want)
    for r in rows:
        ids = next(v for t, v in want.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
        assert r["doc_id"] in ids and (not r["kept"] or r["doc_id"] == r["keep_id"])


def test_filter_keeps_whole_rows(messy, empty):
    out = without_copies(messy, "doc_id", "text")
    assert out.columns == messy.columns
    rows = out.collect()
    assert len(rows) == len({r["text"] or "" for r in messy.collect()})
    assert len({r["text"] or "" for r in rows}) == len(rows)
    assert without_copies(empty, "doc_id", "text").count() == 0
    assert exact_groups(empty, "doc_id", "text").count() == 0


def test_normalisation(spark):
    df = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in exact_groups(df, "doc_id", "text", F.lower).collect()}
    assert not rows[1]["kept"] and rows[1]["keep_id"] == 2 and rows[3]["group_size"] == 1
