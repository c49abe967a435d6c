import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm.suffix_dedup import WIDTH, cut_repeats, digests, sort_passages
from tests.llm.conftest import words


def plain(rows):
    """Row by row in the order of ids; passages of smaller ids only."""
    out, seen = [], set()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for at, (doc_id, text) in enumerate(ordered):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - WIDTH + 1):
            if raw[i : i + WIDTH] in seen:
                gone[i : i + WIDTH] = b"\1" * WIDTH
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
        if at + 1 == len(ordered) or ordered[at + 1][0] != doc_id:
            for d, t in ordered[: at + 1]:
                if d == doc_id:
                    b = (t or "").encode()
                    seen |= {b[i : i + WIDTH] for i in range(len(b) - WIDTH + 1)}
    return sorted(out, key=str)


def found(df, **options):
    return sorted((tuple(r) for r in digests(cut_repeats(df, "doc_id", "text", **options)).collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 60), st.sampled_from(["ab", "aab", "cba", "zz", "abcabd", "ba"])), min_size=1, max_size=6))
def test_passages_come_out_sorted(parts):
    segments = []
    for seed, extra, alphabet in parts:
        r = random.Random(seed)
        segments.append("".join(r.choice(alphabet) for _ in range(WIDTH + extra)).encode())
    data = np.frombuffer(b"".join(segments), np.uint8)
    lengths = np.array([len(s) for s in segments])
    starts = np.cumsum(lengths) - lengths
    order = sort_passages(data, starts, lengths)
    raw = data.tobytes()
    got = [raw[i : i + WIDTH] for i in order]
    every = [s[i : i + WIDTH] for s in segments for i in range(len(s) - WIDTH + 1)]
    assert sorted(got) == sorted(every) and len(set(order.tolist())) == len(order)
    # equal passages are neighbours
    runs = [g for i, g in enumerate(got) if not i or got[i - 1] != g]
    assert len(runs) == len(set(runs))


@pytest.mark.parametrize("options", [{}, {"group_bytes": 40_000, "sort_bytes": 5_000}])
def test_whole_table(docs, texts, options):
    assert found(docs, **options) == plain(texts.items())


def test_shared_passages_repeats_and_shifts(spark):
    passage, line = words(11, 30), "the same line again and again, more than fifty bytes of it\n"
    rows = [(i, words(100 + i, 20) + " " + passage + " " + words(200 + i, i)) for i in range(40)]
    rows += [(50 + i, line * (i + 1)) for i in range(5)] + [(60, "ab" * 400), (61, "ba" * 300), (62, "a" * 49), (63, "a" * 49)]
    rows += [(70, passage[:WIDTH]), (71, passage[: WIDTH - 1]), (72, passage[1 : WIDTH + 1] + "é" * 30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(df) == found(df, group_bytes=2_000, sort_bytes=300) == plain(rows)


def test_messy_documents(messy, empty):
    assert found(messy, group_bytes=100_000) == plain([(r["doc_id"], r["text"]) for r in messy.collect()])
    assert found(empty) == []
