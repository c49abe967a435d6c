"""A corpus pipeline of the operators in ``tablewright.llm``, from documents to packed sequences.

Every stage works on all rows its predecessor kept. Stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import exact_dedup, mixing, ngram_join, packing, quality_classifier
from tablewright.llm.base import documents, labels, prepare
from tablewright.sources.workspace import stage

TOKENIZER = "byte_bpe_50k.json"
NEAR = ngram_join.Similarity(words=5, percent=80)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier does not reject."""
    prepare(spark)
    model = quality_classifier.co_train(docs, labels(spark, sf_dir))
    scored = quality_classifier.score(docs, model)
    return scored.where(F.col("score") >= quality_classifier.THRESHOLD).select(*docs.columns)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with identical texts, the one with the largest id."""
    prepare(spark)
    return exact_dedup.without_copies(docs, "doc_id", "text")


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8), the document with the smallest id."""
    prepare(spark)
    return ngram_join.without_near_duplicates(docs, "doc_id", "text", NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows, interleaved so that every source keeps its share throughout."""
    prepare(spark)
    return mixing.mixed_order(docs, "source", ["doc_id"])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens, with a checksum of their ids.

    Sequences are numbered along the mixture. Written files do not keep the
    order of their rows when they are read, but it follows from the rows.
    """
    mixed = mix_sources(spark, docs, sf_dir)
    return packing.piece_digests(packing.packed(mixed, "doc_id", "text", public_tokenizers.path(TOKENIZER), ordered=True))


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", keep_one_copy),
    ("ngram jaccard join", keep_one_near_copy),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

# A trained classifier, token ids and packing have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages after one another; each result is written and read again."""
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
