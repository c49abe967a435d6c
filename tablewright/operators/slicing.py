"""Row numbers and ranks within keys of any size, and null-safe joins.

Ordered work rests on the range exchange of ``ranges``: no task needs a whole
key, and any orderable type works in any place of the order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ranges import ROWS_PER_PART, global_row_number, row_number_in_key
from tablewright.sources.workspace import stage

# Rows of one sorted partition.
ROWS_PER_SLICE = ROWS_PER_PART


def micros(col: Column | str) -> Column:
    """A zone-less timestamp as a whole number, in order."""
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(col.cast("timestamp"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where null matches null; the left keys are kept.

    The right keys get names of their own, so the two sides may share a plan.
    """
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[F.col(c) for c in right.columns if c not in keys]
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def row_number(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    name: str = "row_number",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Number the rows of each key from 1 in rising order, exactly; missing values come first.

    With no keys the whole table is one group. ``order_by`` must decide every
    tie.
    """
    if keys:
        numbered = row_number_in_key(df, keys, order_by, "_row0", rows_per_slice)
    else:
        numbered = global_row_number(df, order_by, "_row0", rows_per_slice)
    return numbered.select(*df.columns, (F.col("_row0") + 1).alias(name))


def rank_cutoffs(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    rank: Callable[[Column], Column],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The row at a given rank of each key, as ``keys``, ``_cutoff`` struct.

    ``rank`` turns the row count of a key (a column) into the 1-based rank
    wanted; keys whose rank is below 1 are left out. Only the key and order
    columns are read and sorted.
    """
    keys = list(keys)
    flat = df.select(*dict.fromkeys([*keys, *order_by]))
    numbered = row_number(flat, keys, order_by, "_at", rows_per_slice)
    sizes = numbered.groupBy(*keys).agg(F.max("_at").alias("_n"))
    wanted = sizes.select(*keys, rank(F.col("_n")).cast("bigint").alias("_at")).where("_at >= 1")
    return join_null_safe(numbered, wanted, [*keys, "_at"], "left_semi").select(*keys, F.struct(*order_by).alias("_cutoff"))


def pinned(df: DataFrame) -> DataFrame:
    """A table of fitted values (class codes, cut-offs), computed exactly once and written to the shared folder."""
    return stage(df, "fitted")
