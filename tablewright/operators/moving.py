"""Means over sliding frames from running sums: the cost of a row does not depend on the length of the frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.ranges import ROWS_PER_PART, in_order, parts_for
from tablewright.sources.workspace import stage

SCALE = 6  # decimal places that count of a floating-point value

_CARRIED = ["rows", "sum", "count"]


def _exact(value: Column, kind: T.DataType) -> Column:
    """The value as a decimal, in which sums do not depend on their order; NaN is missing."""
    if isinstance(kind, T.DecimalType):
        return value
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value).cast(T.DecimalType(28, SCALE))
    return value.cast(T.DecimalType(20, 0))


def moving_mean(
    df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[str], n: int, name: str = "mean_value",
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """keys, order columns and, at every row, the mean over it and the ``n - 1`` rows of its key before it.

    Missing values count neither in the sum nor in the number; a frame without
    any value has no mean. ``order_by`` must decide ties. The table is ordered
    by one range exchange. Inside a partition exact sums run from its start,
    and a frame is the difference of two of them; what a key has in earlier
    partitions is added from a table of one row per partition. Only the first
    ``n`` rows of a partition can have a frame that begins in an earlier one;
    these look up the one sum they need among the last ``n`` rows there.
    """
    keys, order_by = list(keys), list(order_by)
    flat = df.select(
        *keys, *order_by, _exact(F.col(value), df.schema[value].dataType).alias("_v"),
        (F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))]) if keys else F.lit(0).cast("bigint")).alias("_key"),
    )
    rows = df.count()
    ordered = in_order(flat, [*keys, *order_by], rows_per_part, rows)
    here = Window.partitionBy("_part").orderBy("_pos")
    so_far = here.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("decimal(38,0)")
    summed = ordered.withColumns(
        {
            "_s": F.sum(F.coalesce("_v", zero)).over(so_far),
            "_c": F.count("_v").over(so_far),
            "_new": F.coalesce(F.lag("_key").over(here) != F.col("_key"), F.lit(True)),
        }
    )
    began = lambda x: F.last(F.when(F.col("_new"), x), ignorenulls=True).over(so_far)
    summed = summed.withColumns(
        {
            "_from": began(F.col("_pos")),
            "_s0": began(F.col("_s") - F.coalesce("_v", zero)),
            "_c0": began(F.col("_c") - F.col("_v").isNotNull().cast("bigint")),
            "_s_n": F.lag("_s", n).over(here),
            "_c_n": F.lag("_c", n).over(here),
        }
    )
    placed = summed.join(F.broadcast(_begun(ordered)), "_part")
    old = lambda c: F.when((F.col("_from") == 0) & F.col("_open"), F.col(f"_in_{c}")).otherwise(0)
    placed = placed.select(
        *keys, *order_by, "_key", "_part", "_pos", "_size", "_goes_on",
        (F.col("_pos") - F.col("_from") + old("rows")).alias("_at"),  # place in the key, from 0
        (F.col("_s") - F.col("_s0") + old("sum")).alias("_sum"),  # from the key's first row on
        (F.col("_c") - F.col("_c0") + old("count")).alias("_count"),
        (F.col("_pos") - F.col("_from") >= n).alias("_inside"),
        (F.col("_s") - F.col("_s_n")).alias("_ds"), (F.col("_c") - F.col("_c_n")).alias("_dc"),
    )
    mean = lambda s, c: (F.when(c > 0, s.cast("double") / c)).alias(name)
    near = F.col("_inside") | (F.col("_at") < n)
    direct = [F.when(F.col("_inside"), F.col(f"_d{x}")).otherwise(F.col(f"_{y}")) for x, y in (("s", "sum"), ("c", "count"))]
    if parts_for(df, rows, rows_per_part) == 1:
        return placed.select(*keys, *order_by, mean(*direct))
    placed = stage(placed, "sums")
    ends = placed.where((F.col("_size") - F.col("_pos") <= n) & (F.col("_goes_on") == F.col("_key"))).select(
        F.col("_key").alias("_end_key"), (F.col("_at") + n).alias("_end_at"), F.col("_sum").alias("_s"), F.col("_count").alias("_c")
    )
    far = placed.where(~near).join(ends, (F.col("_key") == F.col("_end_key")) & (F.col("_at") == F.col("_end_at")))
    return placed.where(near).select(*keys, *order_by, mean(*direct)).unionByName(
        far.select(*keys, *order_by, mean(F.col("_sum") - F.col("_s"), F.col("_count") - F.col("_c")))
    )


def _begun(ordered: DataFrame) -> DataFrame:
    """One row per partition: its size, whether its first key began before, with what so far, and the key that goes on after it."""
    by_key = ordered.groupBy("_part", "_key").agg(
        F.min("_pos").alias("at"), F.count(F.lit(1)).alias("rows"), F.sum(F.coalesce("_v", F.lit(0))).alias("sum"), F.count("_v").alias("count")
    )
    parts = by_key.groupBy("_part").agg(
        F.sum("rows").alias("_size"), F.min_by("_key", "at").alias("_first"), F.max_by("_key", "at").alias("_last"),
        *[F.max_by(c, "at").alias(c) for c in _CARRIED],
    )
    of_key = Window.partitionBy("_last").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    by_part = Window.orderBy("_part")
    known = parts.withColumns({c: F.sum(c).over(of_key) for c in _CARRIED})
    return known.select(
        "_part", "_size",
        F.coalesce(F.lag("_last").over(by_part) == F.col("_first"), F.lit(False)).alias("_open"),
        *[F.lag(c).over(by_part).alias(f"_in_{c}") for c in _CARRIED],
        F.when(F.lead("_first").over(by_part) == F.col("_last"), F.col("_last")).alias("_goes_on"),
    )
