import re
from collections import Counter

import pytest

from tablewright.llm.quality_rules import host_verdicts, judge


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed


def test_messy_documents(messy, empty):
    rows = judge(messy, "doc_id", "text", "source").collect()
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                   r["base_failed"]) for r in rows)
    assert got == Counter((r["doc_id"], *plain(r["text"])) for r in messy.collect())
    assert all(r["kept"] is (not r["base_failed"] and not r["host_rejected"]) for r in rows)
    assert judge(empty, "doc_id", "text", "source").count() == 0


def test_prior_shrinks_small_hosts(spark):
    rows = [("good", i % 50 == 0) for i in range(400)] + [("bad", i % 10 != 0) for i in range(400)] + [("one", True)]
    rows += [(f"h{k}", i % 20 == 0) for k in range(20) for i in range(100)] + [(None, True)] * 3
    found = spark.createDataFrame([(h, f, False) for h, f in rows], "_host string, few_words boolean, repetitive boolean")
    out = {r["_host"]: r for r in host_verdicts(found).collect()}
    assert None not in out and out["bad"]["host_rejected"] and not out["good"]["host_rejected"]
    assert out["bad"]["few_words_rate"] == pytest.approx(0.9, abs=0.02)
    # one failure of one document is pulled towards the mean of all hosts, 400 are not
    mean = sum(r["few_words_rate"] * r["n_docs"] for r in out.values()) / sum(r["n_docs"] for r in out.values())
    assert mean < out["one"]["few_words_rate"] < 0.75 and out["one"]["n_docs"] == 1
    assert all(r["repetitive_rate"] == 0 for r in out.values())
