"""Ordered work on tables and keys of any size: one range exchange, staged once.

A window over a key sends all its rows to one task, and a window without a key
sends the whole table there. Here the table is range-partitioned by (keys,
order columns) into as many partitions as its size asks for, small ones only
while they are few, sorted inside each partition and written to the shared folder together
with the number of its partition. Rows of one key are then neighbours, in one
partition or in several that follow each other, and a result for the key is
the result inside the partition plus a summary (one row per partition) of the
partitions before it. Any orderable column type works.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.sources.workspace import stage

ROWS_PER_PART = 1_000_000
_INDEX_BITS = 33  # of monotonically_increasing_id below the partition number


# Parts smaller than this are made while there are few of them: every part costs a task, a file and a line on the driver.
LEAST_ROWS = 100_000
FEW_PARTS = 200


def bounded_parts(rows: int, rows_per_part: int) -> int:
    """Parts of at most so many rows, or of ``LEAST_ROWS`` where that would make more than ``FEW_PARTS``."""
    return max(min(math.ceil(rows / rows_per_part), max(FEW_PARTS, math.ceil(rows / LEAST_ROWS))), 1)


def parts_for(df: DataFrame, rows: int, rows_per_part: int = ROWS_PER_PART) -> int:
    """Partitions for so many rows: bounded rows each (see ``bounded_parts``), and the cores kept busy."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(bounded_parts(rows, rows_per_part), min(cores, math.ceil(rows / 10_000)))


def in_order(
    df: DataFrame, order_by: Sequence[str | Column], rows_per_part: int = ROWS_PER_PART, rows: int | None = None
) -> DataFrame:
    """``df`` sorted across partitions and staged, with ``_part`` and ``_pos`` (from 0 inside the partition).

    ``order_by`` should decide ties: rows that are equal in all of it stay in
    one partition. Missing values come first. ``rows`` saves the count where
    it is known.
    """
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]
    parts = parts_for(df, df.count() if rows is None else rows, rows_per_part)
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = ranged.select(*df.columns, F.monotonically_increasing_id().alias("_at"))
    return stage(
        numbered.select(
            *df.columns,
            F.shiftright("_at", _INDEX_BITS).alias("_part"),
            F.col("_at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)).alias("_pos"),
        ),
        "ordered",
    )


def with_offsets(staged: DataFrame) -> DataFrame:
    """Add ``_before``: the number of rows in all partitions before the row's own.

    The joined table has one row for each of ``rows_per_part`` rows at most.
    """
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return staged.join(F.broadcast(offsets), "_part")


def global_row_number(
    df: DataFrame, order_by: Sequence[str], name: str = "row_number", rows_per_part: int = ROWS_PER_PART,
    rows: int | None = None,
) -> DataFrame:
    """Number all rows from 0 in rising order."""
    numbered = with_offsets(in_order(df, order_by, rows_per_part, rows))
    return numbered.select(*df.columns, (F.col("_before") + F.col("_pos")).alias(name))


def row_number_in_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str = "row_number",
    rows_per_part: int = ROWS_PER_PART, rows: int | None = None,
) -> DataFrame:
    """Number the rows of each key from 0 in rising order; a missing key is a key.

    A row's number is its global number less that of its key's first row, so
    no task needs a whole key.
    """
    numbered = global_row_number(df, [*keys, *order_by], "_row", rows_per_part, rows)
    first = numbered.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.min("_row").alias("_first"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return numbered.join(first, same).select(*df.columns, (F.col("_row") - F.col("_first")).alias(name))
