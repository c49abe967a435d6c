"""Per-key picks, first-seen numbering and moving frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.moving import moving_mean
from tablewright.operators.slicing import ROWS_PER_SLICE, micros, row_number


def pick_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key: the first or last in the order of ``order_by``.

    An aggregate, not a window: rows combine on the map side, so a hot key
    reaches its reducer as one row per task. ``order_by`` must decide ties.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order_by)).alias("_row"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[str] = (), start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """The newest row per key with ``start <= ts <= end``."""
    if start is not None:
        df = df.where(F.col(ts) >= start)
    if end is not None:
        df = df.where(F.col(ts) <= end)
    return pick_per_key(df, keys, [ts, *tie_break], "last")


def latest_artifact(objects: DataFrame, cutoff: Column, wanted: Sequence[str] | None = None) -> DataFrame:
    """Newest object per short name that is not newer than ``cutoff``.

    ``objects`` has ``key`` and ``modified``; the short name is the third
    last and the last part of the key. Of equally new ones the larger key wins.
    """
    parts = F.split("key", "/")
    named = objects.where(F.col("modified") <= cutoff).where(F.size(parts) >= 3).select(
        F.concat_ws("/", F.element_at(parts, -3), F.element_at(parts, -1)).alias("short_name"), "key", "modified"
    )
    if wanted is not None:
        named = named.where(F.col("short_name").isin(list(wanted)))
    return pick_per_key(named, ["short_name"], ["modified", "key"], "last")


def first_seen_codes(df: DataFrame, column: str, order_by: Sequence[str]) -> DataFrame:
    """Number the values of a column by first appearance: (label, code).

    The table is reduced to one row per value before values are numbered.
    """
    first = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).agg(
        F.min(F.struct(*order_by)).alias("_first")
    )
    flat = first.select("label", *[F.col(f"_first.{c}").alias(f"_o{i}") for i, c in enumerate(order_by)])
    numbered = row_number(flat, [], [*[f"_o{i}" for i in range(len(order_by))], "label"], name="_at")
    return numbered.select("label", (F.col("_at") - 1).alias("code"))


def sorted_codes(df: DataFrame, column: str) -> DataFrame:
    """Number the values of a column by sorted order from 0: (label, code)."""
    labels = df.where(F.col(column).isNotNull()).select(F.col(column).alias("label")).distinct()
    return row_number(labels, [], ["label"], name="_at").select("label", (F.col("_at") - 1).alias("code"))


def unique_times(
    df: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[str], step: int = 2,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Make times unique within a key by adding ``step`` microseconds per row.

    Only rows that share key and time are shifted, so the shift stays as
    small as the number of copies. ``tie_break`` orders the copies.
    """
    numbered = row_number(df, [*keys, ts], tie_break, name="_at", rows_per_slice=rows_per_slice)
    shifted = F.timestamp_micros(micros(ts) + F.lit(step) * (F.col("_at") - 1)).cast("timestamp_ntz")
    return numbered.withColumn(ts, shifted).drop("_at")


def shift_by_position(
    df: DataFrame, ts: str, order_by: Sequence[str], step: int = 2, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add ``step`` microseconds times the 0-based row number to every time."""
    numbered = row_number(df, [], order_by, name="_at", rows_per_slice=rows_per_slice)
    shifted = F.timestamp_micros(micros(ts) + F.lit(step) * (F.col("_at") - 1)).cast("timestamp_ntz")
    return numbered.withColumn(ts, shifted).drop("_at")


def last_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], spread_by: str, n: int, salts: int = 64) -> DataFrame:
    """The ``n`` first rows of each key in ``order_by``, in two steps.

    Each key is spread over ``salts`` groups by the hash of a unique column,
    every group keeps its ``n``, and the last step sees at most ``salts * n``
    rows per key. Spark keeps only the leading rows while it sorts.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts))
    inner = Window.partitionBy(*keys, "_salt").orderBy(*order_by)
    outer = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("_salt", salt)
        .withColumn("_rn", F.row_number().over(inner))
        .where(F.col("_rn") <= n)
        .withColumn("_rn", F.row_number().over(outer))
        .where(F.col("_rn") <= n)
        .drop("_salt", "_rn")
    )


def identity_now(df: DataFrame, keys: Sequence[str], value: str, ts: str, unique: str, n: int = 256) -> DataFrame:
    """Mean of a column over the newest ``n`` rows of each key."""
    newest = last_rows(
        df.select(*keys, value, ts, unique), keys, [F.desc(ts), F.desc(unique)], unique, n
    )
    return newest.groupBy(*keys).agg(F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("n"))


def identity_history(
    df: DataFrame, keys: Sequence[str], value: str, ts: str, unique: str, n: int = 256, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """At every row, the mean over it and the ``n - 1`` rows before it (see ``moving_mean``)."""
    return moving_mean(df, keys, value, [ts, unique], n, rows_per_part=rows_per_slice)
