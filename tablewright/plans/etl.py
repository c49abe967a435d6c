"""Loading and refreshing a stored table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from tablewright.operators.columns import add_ingest_time, lowercase_columns
from tablewright.operators.features import FeatureView, OnlineTable
from tablewright.operators.incremental import upsert
from tablewright.operators.versions import VersionedTable


def load(source: DataFrame, target: VersionedTable, note: str = "load") -> DataFrame:
    """Lower-case the column names and make the result the current version."""
    target.write(lowercase_columns(source), note)
    return target.read()


def refresh(
    target: VersionedTable, incoming: DataFrame, keys: Sequence[str], at: datetime, online: OnlineTable | None = None,
    stored_is_unique: bool = False, order_by: Sequence[str] = (),
) -> DataFrame:
    """Stamp the incoming rows, upsert them, store a new version, refresh the serving table.

    ``order_by`` decides between incoming rows of one key; without it such a
    delivery is an error. After the first refresh the stored keys are unique;
    ``stored_is_unique`` then spares the stored table a shuffle.
    """
    stamped = add_ingest_time(lowercase_columns(incoming), at)
    current = target.entry()
    merged = upsert(target.read_entry(current), stamped, keys, order_by, old_is_unique=stored_is_unique)
    target.write(merged, note=f"refresh {at.isoformat(sep=' ')}", after=current)
    if online is not None:
        view = online.view
        fresh = FeatureView(view.name, view.keys, view.ts, view.schema, target.read(), view.created, view.ttl)
        OnlineTable(target.spark, fresh, online.store.root).materialize_incremental(at)
    return target.read()
