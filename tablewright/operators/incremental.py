"""Union, upsert and what is new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.joins import anti, require_unique
from tablewright.operators.ordering import pick_per_key
from tablewright.operators.slicing import join_null_safe
from tablewright.sources.workspace import stage


def upsert(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), old_is_unique: bool = False
) -> DataFrame:
    """``old`` and ``new`` together, one row per key, the new one winning.

    Columns are aligned by name, gaps are null. ``order_by`` decides between
    several rows of one source; without it, a key that one source repeats is
    an error. One aggregate over the union: a key costs one row per task
    however often it was loaded. If ``old`` is known to have unique keys, as a
    table kept by upserts has, it is only compared with the delivered keys.
    """
    if not order_by and not old_is_unique:
        old, old_is_unique = require_unique(old, keys), True
    if old_is_unique:
        delivered = pick_per_key(new, keys, order_by, "last") if order_by else require_unique(new, keys)
        return upsert_unique(old, delivered, keys)
    both = old.withColumn("_source", F.lit(0)).unionByName(
        new.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    return pick_per_key(both, keys, ["_source", *order_by], "last").drop("_source")


def upsert_unique(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same where both sides have unique keys: old rows not replaced, plus new.

    The delivery is written to the shared folder first. Its size in bytes is
    then known, and below the broadcast threshold ``old`` is not shuffled.
    """
    delivered = stage(new, "delivered")
    replaced = join_null_safe(old, delivered.select(*keys), keys, "left_anti")
    return replaced.unionByName(delivered, allowMissingColumns=True)


def new_rows(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not known yet."""
    return anti(incoming, current, keys)
