"""The stages after one another, each held against its definition on its own input."""

from collections import Counter

import corpus_pipeline
from tablewright.llm import mixing
from tablewright.llm.base import documents, labels, prepare
from tablewright.sources.workspace import stage
from tests.llm.conftest import SF
from tests.llm.test_ngram_join import plain_components


def test_every_stage_on_what_its_predecessor_kept(spark):
    (good, keep_good), (_, exact), (_, near), (_, mixed), (_, packed) = corpus_pipeline.STAGES
    start = documents(spark, SF)
    a = stage(keep_good(spark, start, SF), "a")
    assert a.columns == start.columns and a.select("doc_id").distinct().count() == a.count()
    known = {r["doc_id"]: r["quality"] for r in labels(spark, SF).collect()}
    kept = {r["doc_id"] for r in a.select("doc_id").collect()}
    assert sum(d in kept for d, q in known.items() if q == 1) >= 0.9 * sum(known.values())

    b = stage(exact(spark, a, SF), "b")
    last = {}
    for r in a.collect():
        last[r["text"]] = max(r["doc_id"], last.get(r["text"], -1))
    assert {r["doc_id"] for r in b.collect()} == set(last.values()) and b.columns == start.columns

    c = stage(near(spark, b, SF), "c")
    of = plain_components({r["doc_id"]: r["text"] for r in b.collect()}, 5, 80)
    assert {r["doc_id"] for r in c.collect()} == {component for _, component in of.values()} and c.columns == start.columns

    d = stage(mixed(spark, c, SF), "d")
    assert d.columns == start.columns and {tuple(r) for r in d.collect()} == {tuple(r) for r in c.collect()}

    e = packed(spark, d, SF).collect()
    assert {r["doc_id"] for r in e} == {r["doc_id"] for r in d.collect()}
    tokens = {r["doc_id"]: r["doc_tokens"] for r in e}
    assert sum(r["length"] for r in e) == sum(tokens.values())


def test_contract():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_sequences_follow_the_mixture_across_files(spark):
    prepare(spark)
    text = "concat('text ', id, repeat(' some more words of it', 10 + cast(id % 13 AS int)))"
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", f"{text} AS text", "'en' AS lang", "if(id < 300, 'a', if(id < 900, 'b', 'c')) AS source", "10 AS n_chars"
    )
    conf = {"spark.sql.shuffle.partitions": "9", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        mixed = stage(corpus_pipeline.mix_sources(spark, docs, SF), "mixed")
        assert len(mixed.inputFiles()) > 4
        pieces = corpus_pipeline.pack_sequences(spark, mixed, SF).collect()
        order = sorted(mixing.mix(docs.drop("text"), "source", ["doc_id"]).collect(), key=lambda r: r["position"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    source, tokens = {r["doc_id"]: r["source"] for r in order}, {r["doc_id"]: r["doc_tokens"] for r in pieces}
    wanted = [x for r in order for x in [r["source"]] * tokens[r["doc_id"]]]
    got = [x for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])) for x in [source[r["doc_id"]]] * r["length"]]
    assert len(got) == len(wanted)
    tenth = len(got) // 10
    shares = [Counter(wanted[i * tenth : (i + 1) * tenth]) for i in range(10)]
    assert shares[0]["a"] > 0.1 * tenth and shares[9]["a"] == 0  # the smallest source runs out
    for i, share in enumerate(shares):
        here = Counter(got[i * tenth : (i + 1) * tenth])
        assert all(abs(here[s] - share[s]) < 0.08 * tenth for s in "abc")
