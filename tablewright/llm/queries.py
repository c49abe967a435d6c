"""The corpus operators applied to the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    conversation_trie,
    exact_dedup,
    filter_audit,
    language_id,
    license_scan,
    mixing,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    suffix_dedup,
    token_files,
)
from tablewright.llm.base import documents, labels, query
from tablewright.sources.workspace import new_dir


@query("op5_sharding", sharding.oracle())
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "source"), "source", ["doc_id"])


@query("op3_exact_dedup", exact_dedup.ORACLE)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir), "doc_id", "text").drop("n_chunks")


@query("op9_quality_rules", quality_rules.ORACLE)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = {f"{r}_rate": F.round(f"{r}_rate", 9) for r in quality_rules.RULES}
    return quality_rules.judge(documents(spark, sf_dir), "doc_id", "text", "source").withColumns(rates)


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(documents(spark, sf_dir), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
    return packing.piece_digests(pieces)


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.cut_repeats(documents(spark, sf_dir), "doc_id", "text"))


@query("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir), "doc_id", "text")


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_classifier.co_train(docs, labels(spark, sf_dir))
    scored = quality_classifier.score(docs, model, ["doc_id"])
    return scored.withColumn("kept", F.col("score") >= quality_classifier.THRESHOLD)


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.best_license(license_scan.scan(documents(spark, sf_dir), "doc_id", "text"))


@query("op11_conversation_trie", conversation_trie.ORACLE)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "tokens")
    token_files.write_tokens(documents(spark, sf_dir), "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), path)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op13_filter_audit", filter_audit.ORACLE)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failures(documents(spark, sf_dir), labels(spark, sf_dir)))
