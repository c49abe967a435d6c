import numpy as np

from tablewright.llm.language_id import UNKNOWN, build, decide, grams, identify, letters_of, predict, train
from pyspark.sql import functions as F

from tablewright.llm.base import prepare


def test_letters():
    assert "".join(chr(c) if c else "_" for c in letters_of("  Ça va?? 12 OK! ")) == "_ça_va_ok_"
    assert len(letters_of("12 !?")) == 0 and len(letters_of("")) == 0
    assert len(grams(letters_of("a"), 3)) == 1


def test_filters_know_every_gram_and_few_others():
    r = np.random.default_rng(2)
    sets = [r.integers(0, 2**63, n).astype(np.uint64) for n in (5000, 300, 0)]
    f = build(["a", "b", "c"], sets)
    for i, s in enumerate(sets):
        assert ((f.lookup(s) >> np.uint8(i)) & 1).all()
    strange = f.lookup(r.integers(0, 2**63, 200_000).astype(np.uint64))
    for i in range(3):
        rate = ((strange >> np.uint8(i)) & 1).mean()
        assert abs(rate - f.by_chance[i]) < 0.003


def test_chance_hits_are_taken_off():
    text = "zzz qqq xxx www"
    f = build(["small", "large"], [grams(letters_of(text), 3), np.random.default_rng(1).integers(0, 2**63, 3).astype(np.uint64)])
    (names, scores), = decide(f, [text, None, "...", "ööö"])
    assert names == ["small", UNKNOWN, UNKNOWN, "small"] and scores[0] > 0.9 and scores[1] == scores[2] == scores[3] == 0


def test_held_out_accuracy(docs):
    known = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = identify(docs).collect()
    assert len(rows) == len(known)
    held = [r for r in rows if r["held_out"]]
    assert held and sum(r["lang_pred"] == known[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_only_text_decides_and_held_out_rows_do_not_teach(docs):
    base = {r["doc_id"]: tuple(r) for r in identify(docs).collect()}
    other = docs.withColumn("source", F.lit("x")).withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, "??").otherwise(F.col("lang")))
    assert {r["doc_id"]: tuple(r) for r in identify(other).collect()} == base


def test_messy_documents(messy, empty):
    rows = identify(messy).collect()
    assert len(rows) == messy.count()
    text = {r["doc_id"]: r["text"] for r in messy.collect()}
    for r in rows:
        if r["doc_id"] in (4, 5, 6, 7):
            assert r["lang_pred"] == UNKNOWN and r["score"] == 0
        elif text[r["doc_id"]] is not None:
            assert r["lang_pred"] in ("en", "de", "")
    assert identify(empty).count() == 0
    nothing = train(messy, "text", "lang", F.lit(False))
    assert nothing.languages == []


def test_many_languages_and_one_of_a_single_document(spark):
    prepare(spark)
    r = np.random.default_rng(5)
    stock = [["".join(chr(97 + c) for c in r.integers(0, 26, 6)) for _ in range(30)] for _ in range(150)]
    rows = [(i, " ".join(r.permutation(stock[i % 150])), f"x{i % 150}") for i in range(450)]
    rows.append((1000, "\u0436\u0443\u043a \u0431\u0435\u0436\u0438\u0442 \u043f\u043e \u0434\u043e\u0440\u043e\u0433\u0435", "once"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    filters = train(docs, "text", "lang", F.lit(True))
    assert len(filters.languages) == 151
    found = {x["doc_id"]: x["lang_pred"] for x in predict(docs, "doc_id", "text", filters).collect()}
    assert found == {i: lang for i, _, lang in rows}
