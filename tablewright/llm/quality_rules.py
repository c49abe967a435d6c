"""Quality rules for documents and for the hosts they come from.

Each document is measured and judged by rules of its own. The failures of
every rule are then counted by host. A host with few documents says little, so
its rate is shrunk towards the rate of all hosts by a beta prior fitted to the
hosts by moments; a host whose shrunk rate of some rule passes the limit is
rejected, and the verdict is joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.textbytes import Texts, batches_of, windows
from tablewright.sources.workspace import stage

# Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["few_words", "repetitive"]
# A host is rejected where the shrunk rate of one rule is above this.
HOST_LIMIT = 0.5

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each text, whose first indexes (and the end) are given."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _groups(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal (text, key) together, earlier ones first, and flags of those equal to the one before."""
    order = np.lexsort((keys, text))
    same = np.zeros(len(keys), bool)
    k, t = keys[order], text[order]
    same[1:] = (k[1:] == k[:-1]) & (t[1:] == t[:-1])
    return order, same


def measure(texts: Texts) -> list[np.ndarray]:
    """The measures of every text, in the order of ``MEASURES``."""
    n = len(texts)
    start, end, first = texts.words()
    prefix = texts.prefix()
    n_words = np.diff(first)
    # code points: bytes that do not continue one
    points = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=points[1:])
    word_chars = _sums(points[end] - points[start], first)
    n_symbols = _sums(_IS_SYMBOL[texts.data], texts.offsets)

    # lines with a word, equal to an earlier one of the text
    breaks = np.flatnonzero(texts.data == 0x0A)
    line_start = np.union1d(texts.offsets[:-1], breaks + 1)
    line_start = line_start[line_start < len(texts.data)]
    line_end = np.append(line_start[1:], len(texts.data))
    line_end = line_end - np.isin(line_end - 1, breaks)  # without the break that ends it
    worded = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end = line_start[worded], line_end[worded]
    line_text = np.searchsorted(texts.offsets, line_start, "right") - 1
    _, same = _groups(texts.spans_hash(prefix, line_start, line_end), line_text)
    n_dup_lines = np.bincount(line_text[same], minlength=n)  # order within a text does not matter for a count

    # words in three-word windows found twice or more
    shingle, where = windows(texts.spans_hash(prefix, start, end), first, 3)
    shingle_text = np.repeat(np.arange(n), np.diff(where))
    order, same = _groups(shingle, shingle_text)
    twice = same.copy()
    twice[:-1] |= same[1:]
    at = order[twice]
    at = at - where[shingle_text[at]] + first[shingle_text[at]]  # index of the window's first word
    marked = np.zeros(len(start) + 2, bool)
    for i in range(3):
        marked[at + i] = True
    n_repeat_words = _sums(marked[: len(start)], first)
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words]


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in batches_of(batches, "_text"):
        values = [pa.array(v, pa.int64()) for v in measure(texts)]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_host"), *values], names=["_id", "_host", *MEASURES])


def measured(docs: DataFrame, id_column: str, text: str, host: str) -> DataFrame:
    """_id, _host, the measures and one boolean per rule, a row for each document."""
    flat = docs.select(F.col(id_column).alias("_id"), F.col(host).cast("string").alias("_host"), F.col(text).alias("_text"))
    kind = flat.schema["_id"].dataType.simpleString()
    out = flat.mapInArrow(_measured, f"_id {kind}, _host string, " + ", ".join(f"{m} bigint" for m in MEASURES))
    return out.withColumns(
        {
            "few_words": F.col("n_words") < MIN_WORDS,
            "repetitive": 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"),
        }
    )


def host_verdicts(found: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """_host, n_docs, the shrunk rate of every rule and host_rejected, one row per named host.

    The prior has the mean of the hosts' rates and their spread beyond what
    counts of that size show by chance (method of moments); hosts that differ
    by no more than chance are all shrunk to the mean. The moments are sums
    over hosts, so what comes to the driver is one row of numbers.
    """
    counts = found.where(F.col("_host").isNotNull()).groupBy("_host").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(F.col(r).cast("bigint")).alias(f"_f_{r}") for r in RULES]
    )
    moments = [F.count(F.lit(1)).alias("_hosts"), F.sum(1 / F.col("n_docs")).alias("_inverse")]
    for r in RULES:
        rate = F.col(f"_f_{r}") / F.col("n_docs")
        moments += [F.avg(rate).alias(f"_m_{r}"), F.var_samp(rate).alias(f"_v_{r}")]
    of_all = counts.agg(*moments).first().asDict()
    out = counts.withColumns({k: F.lit(v).cast("double") for k, v in of_all.items()})
    rejected = F.lit(False)
    for r in RULES:
        mean, chance = F.col(f"_m_{r}"), F.col(f"_m_{r}") * (1 - F.col(f"_m_{r}"))
        spread = F.coalesce(F.col(f"_v_{r}"), F.lit(0.0)) - chance * F.col("_inverse") / F.col("_hosts")
        # beta prior: its weight counts like so many documents
        weight = F.when(spread > 0, F.greatest(chance / spread - 1, F.lit(0.0)))
        shrunk = F.when(weight.isNull(), mean).otherwise(
            (F.col(f"_f_{r}") + weight * mean) / (F.col("n_docs") + weight)
        )
        out = out.withColumn(f"{r}_rate", shrunk)
        rejected = rejected | (F.col(f"{r}_rate") > limit)
    return out.select("_host", "n_docs", *[f"{r}_rate" for r in RULES], rejected.alias("host_rejected"))


def judge(docs: DataFrame, id_column: str, text: str, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """Every document with its measures, base_failed, the rates and verdict of its host, and kept.

    A missing text has no words; a missing host has no verdict, and its
    documents are judged by themselves. An empty table gives an empty one.
    Other columns are not read; repeated rows are judged each.
    """
    found = stage(measured(docs, id_column, text, host), "measured")  # read for the counts and for the verdicts
    verdicts = host_verdicts(found, limit).withColumnRenamed("_host", "_verdict_host")
    joined = found.join(verdicts, F.col("_host") == F.col("_verdict_host"), "left")
    failed = F.lit(False)
    for r in RULES:
        failed = failed | F.col(r)
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.select(
        F.col("_id").alias(id_column), *MEASURES, failed.alias("base_failed"),
        *[f"{r}_rate" for r in RULES], rejected.alias("host_rejected"), (~failed & ~rejected).alias("kept"),
    )


ORACLE = """
WITH words AS (
  SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM words, unnest(range(1, len(w) - 1)) AS t(i)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT word_at) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS word_at FROM twice)
  GROUP BY doc_id),
found AS (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(w) < 50 AS few, 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS repetitive
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
counts AS (
  SELECT source, count(*) AS n, sum(few::INT) AS f1, sum(repetitive::INT) AS f2 FROM found
  WHERE source IS NOT NULL GROUP BY source),
moments AS (
  SELECT count(*) AS hosts, sum(1.0 / n) AS inverse, avg(f1 / n) AS m1, avg(f2 / n) AS m2,
    coalesce(var_samp(f1 / n), 0) AS v1, coalesce(var_samp(f2 / n), 0) AS v2 FROM counts),
prior AS (
  SELECT *, v1 - m1 * (1 - m1) * inverse / hosts AS s1, v2 - m2 * (1 - m2) * inverse / hosts AS s2 FROM moments),
rates AS (
  SELECT source,
    CASE WHEN s1 > 0 THEN (f1 + greatest(m1 * (1 - m1) / s1 - 1, 0) * m1) / (n + greatest(m1 * (1 - m1) / s1 - 1, 0))
      ELSE m1 END AS few_words_rate,
    CASE WHEN s2 > 0 THEN (f2 + greatest(m2 * (1 - m2) / s2 - 1, 0) * m2) / (n + greatest(m2 * (1 - m2) / s2 - 1, 0))
      ELSE m2 END AS repetitive_rate
  FROM counts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few OR repetitive AS base_failed,
  round(few_words_rate, 9) AS few_words_rate, round(repetitive_rate, 9) AS repetitive_rate,
  coalesce(few_words_rate > 0.5 OR repetitive_rate > 0.5, false) AS host_rejected,
  NOT (few OR repetitive) AND NOT coalesce(few_words_rate > 0.5 OR repetitive_rate > 0.5, false) AS kept
FROM found LEFT JOIN rates USING (source)
"""
