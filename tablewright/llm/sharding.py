"""Reproducible shuffle into shards by a permutation that can be computed for any row.

Rows get dense numbers 0 .. n-1; a keyed Feistel network permutes these
numbers, and the permuted number gives shard (remainder) and slot (quotient).
Nothing but n and the seed is needed to find the place of a row, or the row at
a place, and no row is sorted by a random key.

The network works on pairs (left, right) of a grid ``a x b`` with
``a = ceil(sqrt(n))`` and ``b = ceil(n / a)``. The grid has fewer than ``a``
cells too many; a number that lands on one of them is permuted again until it
is below n (cycle walking), which keeps the whole a permutation of 0 .. n-1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.ranges import ROWS_PER_PART, global_row_number

PRIME = 2**31 - 1  # products of two remainders fit a bigint
ROUNDS = 6


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Three numbers per round, from a linear congruential sequence."""
    keys, x = [], (seed * 2 + 1) % 2**64
    for _ in range(3 * rounds):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        keys.append(1 + (x >> 33) % (PRIME - 1))
    return [tuple(keys[i : i + 3]) for i in range(0, 3 * rounds, 3)]


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0 .. n-1 fixed by n and the seed."""

    n: int
    seed: int = 17
    rounds: int = ROUNDS

    @property
    def a(self) -> int:
        return max(1, math.isqrt(max(self.n - 1, 0)) + 1)

    @property
    def b(self) -> int:
        return max(1, -(-self.n // self.a))

    def _mixed(self, half, key):
        t = (half % PRIME * key[0] + key[1]) % PRIME
        return (t * t % PRIME + key[2]) % PRIME

    def _pass(self, x: str) -> str:
        """SQL for one pass of the network over the number ``x``.

        The rounds are a fold over the list of their keys, so the expression
        stays short whatever their number.
        """
        keys = ", ".join(
            f"named_struct('even', {str(i % 2 == 0).lower()}, 'k0', {k0}L, 'k1', {k1}L, 'k2', {k2}L)"
            for i, (k0, k1, k2) in enumerate(round_keys(self.seed, self.rounds))
        )

        def moved(to: str, by: str, size: int) -> str:
            t = f"((s.{by} % {PRIME}L * k.k0 + k.k1) % {PRIME}L)"
            return f"(s.{to} + ({t} * {t} % {PRIME}L + k.k2) % {PRIME}L) % {size}L"

        even = f"named_struct('l', {moved('l', 'r', self.a)}, 'r', s.r)"
        odd = f"named_struct('l', s.l, 'r', {moved('r', 'l', self.b)})"
        start = f"named_struct('l', {x} div {self.b}L, 'r', {x} % {self.b}L)"
        return f"aggregate(array({keys}), {start}, (s, k) -> IF(k.even, {even}, {odd}), s -> s.l * {self.b}L + s.r)"

    def walks(self, spark: SparkSession) -> int:
        """The most passes any number needs: the longest walk over cells beyond n, plus one.

        Those cells are fewer than ``a``; they are followed as a table. Each
        walk that leads back has a cell that arrives in every step until its
        longest does, so when none arrives, what is left are cycles among
        themselves, which no number ever enters.
        """
        cells, passes = spark.range(self.n, self.a * self.b), 1
        left = self.a * self.b - self.n
        while left:
            cells = cells.select(F.expr(self._pass("id")).alias("id")).where(F.col("id") >= self.n)
            before, left = left, cells.count()
            if left == before:
                break
            passes += 1
        return passes

    def column(self, spark: SparkSession, name: str) -> Column:
        """The permuted number of the numbers in ``name``."""
        again = f"IF(i > 1 AND x < {self.n}L, x, {self._pass('x')})"
        return F.expr(f"aggregate(sequence(1, {self.walks(spark)}), {name}, (x, i) -> {again})")

    def at(self, x: int) -> int:
        """The permuted number of one row number."""
        while True:
            half = list(divmod(x, self.b))
            for i, key in enumerate(round_keys(self.seed, self.rounds)):
                half[i % 2] = (half[i % 2] + self._mixed(half[1 - i % 2], key)) % (self.a, self.b)[i % 2]
            x = half[0] * self.b + half[1]
            if x < self.n:
                return x

    def row_at(self, y: int) -> int:
        """The row number that is permuted to ``y``."""
        keys = round_keys(self.seed, self.rounds)
        while True:
            half = list(divmod(y, self.b))
            for i in reversed(range(self.rounds)):
                half[i % 2] = (half[i % 2] - self._mixed(half[1 - i % 2], keys[i])) % (self.a, self.b)[i % 2]
            y = half[0] * self.b + half[1]
            if y < self.n:
                return y


def shard_rows(
    df: DataFrame, order_by: list[str], shards: int, seed: int = 17, shard: str = "shard", slot: str = "slot",
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Every row of ``df`` with its shard and its slot there.

    Shard sizes differ by one at most and slots are gapless from 0. The place
    of a row depends on its rank in ``order_by``, the number of rows and the
    seed alone. Rows equal in all order columns are interchangeable; missing
    values come first. An empty table gives an empty one. Columns of ``df``
    named like an added column are replaced.
    """
    kept = [c for c in df.columns if c not in (shard, slot)]
    rows = df.count()
    numbered = global_row_number(df.select(*kept), order_by, "_number", rows_per_part, rows)
    placed = numbered.withColumn("_place", Permutation(rows, seed).column(df.sparkSession, "_number"))
    return placed.select(
        *kept, (F.col("_place") % shards).cast("int").alias(shard), F.expr(f"_place div {shards}L").alias(slot)
    )


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    Size is the bytes of the text (none if it is missing) plus 16; the
    checksum of a missing text is that of no bytes, 0. Only the three facts
    travel, never the text. The law is ``rows``: counts at most one apart.
    """
    facts = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
    )
    placed = shard_rows(facts, ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def oracle(shards: int = 40, seed: int = 17) -> str:
    """The same placement in SQL: the network as nested selects, the cycles walked by recursion."""
    passed = "SELECT id, step, a, b, n, x // b AS l, x % b AS r FROM walk, grid WHERE step = 0 OR x >= n"
    for i, (k0, k1, k2) in enumerate(round_keys(seed)):
        to, by, size = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
        t = f"((({by} % {PRIME}) * {k0} + {k1}) % {PRIME})"
        passed = (
            f"SELECT id, step, a, b, n, ({to} + ({t} * {t} % {PRIME} + {k2}) % {PRIME}) % {size} AS {to}, {by} FROM ({passed})"
        )
    # CRC-32, reflected polynomial 0xEDB88320, by a table of 256 entries
    shifted = "list_reduce(range(8), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i)"
    octet = "('0x' || substr(h, 2 * i + 1, 2))::BIGINT"
    return f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS h, row_number() OVER (ORDER BY doc_id) - 1 AS id FROM documents),
grid AS (SELECT n, a, (n + a - 1) // a AS b FROM (
  SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS a FROM documents)),
walk AS (
  SELECT id, id AS x, 0 AS step FROM rows_
  UNION ALL
  SELECT id, l * b + r AS x, step + 1 AS step FROM ({passed})),
tab AS (SELECT list_transform(range(256), lambda i: {shifted}) AS tab),
crc AS (SELECT id, xor(4294967295, list_reduce(
  list_transform(range(length(h) // 2), lambda i: {octet}),
  lambda c, o: xor(tab[(xor(c, o) & 255) + 1], c >> 8), 4294967295)) AS text_crc32 FROM rows_, tab)
SELECT doc_id, length(h) // 2 + 16 AS size, text_crc32, 'rows' AS law, CAST(x % {shards} AS INT) AS shard,
  x // {shards} AS slot, CAST(NULL AS INT) AS grown_shard
FROM rows_ JOIN crc USING (id) JOIN walk USING (id), grid WHERE step > 0 AND x < n
"""
