"""Equi-joins and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.slicing import join_null_safe


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def duplicate_keys(df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*_keys(on)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Return ``df`` if its keys are unique, else raise; guards against rows that multiply."""
    found = duplicate_keys(df, on).limit(1).collect()
    if found:
        raise ValueError(f"key is not unique: {found[0].asDict()}")
    return df


def merge(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    suffixes: tuple[str, str] = ("_x", "_y"),
    null_safe: bool = True,
) -> DataFrame:
    """Join on equal keys, keeping the key once and suffixing clashing names.

    Left columns come first in their order, then the right ones without the
    key. ``null_safe`` lets a missing key match a missing key. No strategy is
    forced: a side below the broadcast threshold is broadcast, larger ones
    are sort-merged and a hot key is split at run time.
    """
    keys = _keys(on)
    if how not in ("left", "inner"):
        raise ValueError(how)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    l = left.select([F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in left.columns])
    kept = [c for c in right.columns if c not in keys]
    r = right.select(
        [F.col(k).alias(f"_right_{k}") for k in keys]
        + [F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c) for c in kept]
    )
    condition = F.lit(True)
    for k in keys:
        a, b = F.col(k), F.col(f"_right_{k}")
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return l.join(r, condition, how).drop(*[f"_right_{k}" for k in keys])


def anti(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; null matches null.

    The right side is cut down to its distinct keys first. That combines on
    the map side, so a key with many copies is shuffled once per task. Where
    the optimiser finds them small, the left side stays where it is.
    """
    keys = _keys(on)
    return join_null_safe(left, right.select(*keys).distinct(), keys, "left_anti")


def lookup(keys_df: DataFrame, snapshot: DataFrame, on: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Stored values for the given keys, in the order of ``columns``; a miss is null.

    A first join finds the hits, without moving the snapshot where the
    optimiser finds the request small; the misses are added from the request.
    """
    keys = _keys(on)
    wanted = snapshot.select(*keys, *columns)
    request = keys_df.select(*keys)
    hits = join_null_safe(wanted, request.distinct(), keys, "left_semi")
    return join_null_safe(request, hits, keys).select(*keys, *columns)


def decode(df: DataFrame, codes: DataFrame, code: str, label: str = "label") -> DataFrame:
    """Add the label of a class number from a ``(label, code)`` table."""
    table = codes.select(F.col("code").alias("_code"), F.col("label").alias(label))
    return df.join(table, F.col(code) == F.col("_code"), "left").drop("_code")
