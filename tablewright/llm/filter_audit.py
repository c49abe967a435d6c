"""How filters of a corpus act on each other, in every order they could be applied.

A game is played by the filters: a coalition of them removes the documents
that at least one of its members fails. The potential of a coalition (Hart and
Mas-Colell) is what it removes, plus the potentials of the coalitions without
one member, divided by its size. A filter's Shapley value is the potential of
all filters less the potential without it, and what it removes at a step of an
order is the difference between the coalition with it and the coalition of
those before it. So one count of documents per set of failed filters answers
all orders, and texts are read once.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.sources.workspace import stage

# Fixed values of the contract.
FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_CAPITALS_PERCENT = 5
SYMBOL = "[#$%&*|]"

_GAMES = ["removed", "good", "toxic"]


def text_failures(text: Column) -> list[Column]:
    """Whether a text fails the filters A to D; a missing text is an empty one."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)).cast("bigint") < LEAST_DISTINCT_PERCENT * F.size(words).cast("bigint"),
        100 * capitals.cast("bigint") > MOST_CAPITALS_PERCENT * F.length(text).cast("bigint"),
        text.rlike(SYMBOL),
    ]


def _mask(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, (f.cast("int") * (1 << i) for i, f in enumerate(flags)))


def failures(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, mask (bit i: fails the i-th filter), good, toxic of every document.

    A document repeats another if its text is that of a document with a
    smaller id, wherever that is and whatever became of it; a document without
    id neither repeats nor is repeated. Texts are compared by their SHA-256.
    Only the smallest id of each text is joined back, so a text with many
    copies meets no task as a whole. A document is good or toxic if any of its
    labels says so, and neither without id or label.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    facts = stage(
        docs.select(
            F.col(id_column).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            _mask(text_failures(F.col(text))).alias("_own"), F.unhex(F.sha2(whole.cast("binary"), 256)).alias("_text"),
        ),
        "audit",
    )
    named = facts.where(F.col("_id").isNotNull())
    first = named.groupBy("_text").agg(F.min("_id").alias("_id")).withColumn("_first", F.lit(True))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    repeats = 1 << FILTERS.index("E")
    judged = named.join(first, ["_text", "_id"], "left").join(marks, "_id", "left").select(
        "part", (F.col("_own") + F.when(F.col("_first"), 0).otherwise(repeats)).alias("mask"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    nameless = facts.where(F.col("_id").isNull()).select(
        "part", F.col("_own").alias("mask"), F.lit(False).alias("good"), F.lit(False).alias("toxic")
    )
    return judged.unionByName(nameless)


def coalition_counts(found: DataFrame, n: int) -> DataFrame:
    """One row per part: its documents, and per game an array of what each of the 2**n coalitions removes."""
    by_mask = found.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("removed"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    sums = {g: ", ".join(f"sum(if(mask & {s} != 0, {g}, 0))" for s in range(1 << n)) for g in _GAMES}
    return by_mask.groupBy("part").agg(
        F.sum("removed").alias("n_docs"), *[F.expr(f"array({sums[g]})").alias(g) for g in _GAMES]
    )


def potentials(worth: str, n: int) -> Column:
    """The potentials of all coalitions, each times the factorial of its size, which makes it a whole number.

    With Q(S) = |S|! P(S) the recursion P(S) = (v(S) + sum of P(S - i)) / |S|
    becomes Q(S) = (|S| - 1)! v(S) + sum of Q(S - i). It is linear, so each
    potential is a sum of the coalitions' worths with fixed weights.
    """
    weights: list[dict[int, int]] = [{}]
    for s in range(1, 1 << n):
        here = {s: math.factorial(s.bit_count() - 1)}
        for i in range(n):
            if s >> i & 1:
                for t, w in weights[s ^ 1 << i].items():
                    here[t] = here.get(t, 0) + w
        weights.append(here)
    sums = [" + ".join([f"{w} * {worth}[{t}]" for t, w in terms.items()] or ["0"]) for terms in weights]
    return F.expr(f"array({', '.join(f'bigint({x})' for x in sums)})")


def _steps(filters: str) -> Column:
    """Every order of the filters and step of it, with the coalitions before and of this step."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    steps = [
        {"filter_order": "".join(order), "step": k + 1, "before": sum(bit[f] for f in order[:k]), "alone": bit[order[k]]}
        for order in permutations(filters) for k in range(len(filters))
    ]
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, before: int, alone: int>>")


def audit(found: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step.

    ``kept`` after the step, ``removed`` at it, ``redundant`` (fails this filter,
    removed earlier), ``unique_fails`` (fails this filter only), the good and
    toxic documents lost at it, and ``shapley``: what the filter removes, summed
    over all orders, which is its Shapley value times the number of orders. An
    empty table gives an empty one.
    """
    n, everyone = len(filters), (1 << len(filters)) - 1
    # 2**n numbers per part and game
    parts = stage(coalition_counts(found, n).withColumn("_potential", potentials("removed", n)), "coalitions")
    rows = parts.withColumn("_at", F.explode(_steps(filters))).select("*", "_at.*")
    alone, before = F.col("alone"), F.col("before")
    after = before.bitwiseOR(alone)
    at = lambda game, coalition: F.element_at(game, coalition + 1)
    gone = lambda game: at(game, after) - at(game, before)
    return rows.select(
        "part", "filter_order", "step",
        (F.col("n_docs") - at("removed", after)).alias("kept"),
        gone("removed").alias("removed"),
        (at("removed", alone) - gone("removed")).alias("redundant"),
        (at("removed", F.lit(everyone)) - at("removed", F.lit(everyone) - alone)).alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        # n! (P(N) - P(N - i)), of potentials scaled by n! and (n - 1)!
        (at("_potential", F.lit(everyone)) - n * at("_potential", F.lit(everyone) - alone)).alias("shapley"),
    )


ORACLE = """
WITH facts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (
  SELECT part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
      100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t),
      regexp_matches(t, '[#$%&*|]'),
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM facts LEFT JOIN marks USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || d.c || e.c || f.c AS filter_order FROM letters a, letters b, letters d, letters e, letters f
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
kinds AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged
  GROUP BY part, fails),
placed AS (
  SELECT part, filter_order, step, n, good, toxic, filter_order[step] AS letter, fails[ascii(filter_order[step]) - 64] AS now,
    len(list_filter(range(1, step), lambda i: fails[ascii(filter_order[i]) - 64])) > 0 AS earlier,
    len(list_filter(fails, lambda x: x)) = 1 AS single FROM kinds, steps),
counted AS (
  SELECT part, filter_order, step, letter, sum(n) FILTER (NOT now AND NOT earlier) AS kept,
    sum(n) FILTER (now AND NOT earlier) AS removed, sum(n) FILTER (now AND earlier) AS redundant,
    sum(n) FILTER (now AND single) AS unique_fails, sum(good) FILTER (now AND NOT earlier) AS good_lost,
    sum(toxic) FILTER (now AND NOT earlier) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
