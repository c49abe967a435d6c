"""Point-in-time joins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.ranges import parts_for
from tablewright.operators.slicing import ROWS_PER_SLICE, join_null_safe
from tablewright.sources.workspace import stage


@dataclass(frozen=True)
class AsOf:
    """Feature rows to be matched: their time, the columns wanted, what decides ties, and how long they are valid."""

    features: DataFrame
    ts: str
    columns: tuple[str, ...]
    tie_break: tuple[str, ...] = ()
    ttl: timedelta | None = None
    ts_alias: str | None = None


def asof_join(
    entities: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    entity_ts: str,
    feature_ts: str,
    columns: Sequence[str],
    tie_break: Sequence[str] = (),
    ttl: timedelta | None = None,
    unmatched: str = "null",
    ts_alias: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """For each entity row the newest feature row of its key at or before its time.

    ``columns`` of the feature row are added (null if there is none);
    ``tie_break`` decides between feature rows of equal time, the largest
    wins. With a ``ttl`` a feature older than that is no match; both bounds
    are inclusive and a zero ``ttl`` means none. ``unmatched`` is ``"null"``
    (every entity row survives) or ``"drop_expired"`` (a row is dropped if its
    key has feature rows but none of them is valid at its time). ``ts_alias``
    keeps the matched feature time under that name.
    """
    view = AsOf(features, feature_ts, tuple(columns), tuple(tie_break), ttl, ts_alias)
    return asof_views(entities, [view], keys, entity_ts, unmatched, rows_per_slice)


def asof_views(
    entities: DataFrame, views: Sequence[AsOf], keys: Sequence[str], entity_ts: str, unmatched: str = "null",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``asof_join`` with several feature tables of the same keys, in one pass.

    Entities and all feature rows are put into one ordered stream by a single
    range exchange. Each sorted partition is read once, in Arrow batches, with
    one carried row per view: no pairs, no window, no second shuffle. A key
    that fills several partitions gets the last feature rows of the earlier
    ones from a table of one row per partition. An instant may be as large as
    it likes: entity rows of it are told apart by their hash, since all of
    them get the same match. With ``drop_expired`` a row goes if that holds
    for any of the views.
    """
    if unmatched not in ("null", "drop_expired"):
        raise ValueError(unmatched)
    keys = list(keys)
    kinds = [f"_m{i}" for i in range(len(views))]
    parts = []
    for i, view in enumerate(views):
        rank = F.struct(F.col(view.ts).alias("ts"), *[F.col(c).alias(f"t{j}") for j, c in enumerate(view.tie_break)])
        parts.append(
            view.features.select(
                *keys, F.col(view.ts).alias("_ts"), F.lit(0).alias("_side"), rank.alias(f"_r{i}"),
                F.struct(F.col(view.ts).alias("ts"), *[F.col(c).alias(f"c{j}") for j, c in enumerate(view.columns)]).alias(f"_m{i}"),
            )
        )
    parts.append(
        entities.select(
            *keys, F.col(entity_ts).alias("_ts"), F.lit(1).alias("_side"), F.xxhash64(*entities.columns).alias("_spread"),
            F.struct(*entities.columns).alias("_entity"),
        )
    )
    stream = parts[0]
    for part in parts[1:]:
        stream = stream.unionByName(part, allowMissingColumns=True)
    order = [F.col(c).asc_nulls_first() for c in [*keys, "_ts", "_side", *[f"_r{i}" for i in range(len(views))], "_spread"]]
    n_parts = parts_for(entities, entities.count() + sum(v.features.count() for v in views), rows_per_slice)
    # one number tells neighbouring keys apart, and whether a key goes on in the next partition
    key = F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))]) if keys else F.lit(0).cast("bigint")
    ordered = stream.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).select(
        key.alias("_key"), "_side", "_entity", *kinds
    )
    schema = T.StructType(
        [
            T.StructField("_part", T.IntegerType()), T.StructField("_first", T.LongType()), T.StructField("_last", T.LongType()),
            T.StructField("_open", T.BooleanType()), *ordered.select("_entity", *kinds).schema.fields,
        ]
    )
    carried = stage(ordered.mapInArrow(_carrier(len(views)), schema), "asof")
    rows = _carry_between_partitions(carried, kinds)

    for i, view in enumerate(views):
        if view.ttl is not None and view.ttl.total_seconds() != 0:
            valid = F.col(f"_m{i}.ts") >= F.col(f"_entity.{entity_ts}") - F.lit(view.ttl)
            stale = F.col(f"_m{i}").isNotNull() & ~valid
            if unmatched == "drop_expired":
                rows = rows.where(~stale)
            rows = rows.withColumn(f"_m{i}", F.when(valid, F.col(f"_m{i}")))
    if unmatched == "drop_expired":
        rows = _without_known(rows, views, keys, kinds)
    result: list[Column] = [F.col(f"_entity.{c}").alias(c) for c in entities.columns]
    for i, view in enumerate(views):
        if view.ts_alias:
            result.append(F.col(f"_m{i}.ts").alias(view.ts_alias))
        result += [F.col(f"_m{i}.c{j}").alias(c) for j, c in enumerate(view.columns)]
    return rows.select(*result)


def _carrier(n_views: int):
    """Entity rows of a sorted partition with the last feature row of each view, then one row about the partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names = ["_part", "_first", "_last", "_open", "_entity", *[f"_m{i}" for i in range(n_views)]]
        first = last = None
        opening = True  # still within the first key of the partition
        carry: list[pa.Array] = []
        entity_type = None

        def batch_of(n: int, edge: bool, opens, entity: pa.Array, matches: list[pa.Array]) -> pa.RecordBatch:
            ends = [pa.array([x if edge else None] * n, pa.int64()) for x in (first, last)]
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), *ends, pa.array(opens, pa.bool_()), entity, *matches], names=names
            )

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column("_key").to_numpy(zero_copy_only=False)
            if first is None:
                first = last = int(key[0])
                entity_type = batch.column("_entity").type
                carry = [pa.nulls(1, batch.column(f"_m{i}").type) for i in range(n_views)]
            at = np.arange(n)
            change = np.empty(n, bool)
            change[0], change[1:] = key[0] != last, key[1:] != key[:-1]
            begin = np.maximum.accumulate(np.where(change, at, 0))
            goes_on = np.cumsum(change) == 0  # the key of the batch before
            entity = np.flatnonzero(batch.column("_side").to_numpy(zero_copy_only=False) == 1)
            matches = []
            for i in range(n_views):
                rows = batch.column(f"_m{i}")
                seen = np.maximum.accumulate(np.where(rows.is_valid().to_numpy(zero_copy_only=False), at, -1))
                here = seen >= begin
                where = np.where(here, seen, n)  # row n is the one carried in
                none = ~here & ~goes_on
                pool = pa.concat_arrays([rows, carry[i]])
                matches.append(pool.take(pa.array(where[entity], pa.int64(), mask=none[entity])))
                carry[i] = pool.take(pa.array(where[-1:], pa.int64(), mask=none[-1:]))
            if len(entity):
                opens = (goes_on & opening)[entity]
                yield batch_of(len(entity), False, opens, batch.column("_entity").take(pa.array(entity)), matches)
            opening = opening and bool(goes_on[-1])
            last = int(key[-1])
        if first is not None:
            yield batch_of(1, True, [None], pa.nulls(1, entity_type), carry)

    return run


def _carry_between_partitions(carried: DataFrame, kinds: list[str]) -> DataFrame:
    """The entity rows; those of a partition's first key get what earlier partitions know of it.

    The table joined back has one row per partition.
    """
    edges = carried.where(F.col("_first").isNotNull())
    same_key = Window.partitionBy("_last").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    by_part = Window.orderBy("_part")
    known = edges.select("_part", "_first", "_last", *[F.last(m, ignorenulls=True).over(same_key).alias(m) for m in kinds])
    before = known.select(
        "_part",
        *[F.when(F.lag("_last").over(by_part) == F.col("_first"), F.lag(m).over(by_part)).alias(f"_in{m}") for m in kinds],
    )
    rows = carried.where(F.col("_first").isNull()).join(F.broadcast(before), "_part", "left")
    return rows.select(
        "_entity", *[F.coalesce(m, F.when(F.col("_open"), F.col(f"_in{m}"))).alias(m) for m in kinds]
    )


def _without_known(rows: DataFrame, views: Sequence[AsOf], keys: list[str], kinds: list[str]) -> DataFrame:
    """Drop rows without a match in a view that has rows of their key, all of them later; only such rows are joined."""
    some = F.lit(False)
    for m in kinds:
        some = some | F.col(m).isNull()
    open_rows = rows.where(some).select("*", *[F.col(f"_entity.{k}").alias(k) for k in keys])
    for m, view in zip(kinds, views):
        known = view.features.select(*keys).distinct().withColumn("_known", F.lit(True))
        open_rows = join_null_safe(open_rows, known, keys)
        open_rows = open_rows.where(F.col(m).isNotNull() | F.col("_known").isNull()).drop("_known")
    return rows.where(~some).unionByName(open_rows.select("_entity", *kinds))


def one_row_per_instant(df: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[str]) -> DataFrame:
    """Collapse rows of equal key and time to the one with the largest tie-break."""
    rest = [c for c in df.columns if c not in keys and c != ts]
    picked = df.groupBy(*keys, ts).agg(F.max_by(F.struct(*rest), F.struct(*tie_break)).alias("_row"))
    return picked.select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])
