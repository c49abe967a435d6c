"""Small column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def path_part(col: Column, position: int, sep: str = "/") -> Column:
    """One part of a path, counted from the end if negative; null if too short."""
    parts = F.split(col, sep)
    return F.try_element_at(parts, F.lit(position))


def version_stamp(ts: Column) -> Column:
    """A time as a sortable ten-digit stamp: two digits each of year, month, day, hour, minute."""
    return F.date_format(ts, "yyMMddHHmm")


def argmax(values: Column) -> Column:
    """0-based position of the largest element; the first one wins a tie."""
    return F.array_position(values, F.array_max(values)) - 1


def probabilities_to_rows(df: DataFrame, ids: Sequence[str], values: str) -> DataFrame:
    """One row per element of an array: ids, code, probability."""
    return df.select(*ids, F.posexplode(values).alias("code", "probability"))


def metadata_map(entries: Mapping[str, Column], extra: Column | None = None, drop: Sequence[str] = ()) -> Column:
    """A map from named columns, merged with ``extra`` (which wins), without the dropped keys."""
    pairs = [part for name, value in entries.items() for part in (F.lit(name), value.cast("string"))]
    base = F.create_map(*pairs)
    if extra is not None:
        kept = F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(extra), k))
        base = F.map_concat(kept, extra)
    return F.map_filter(base, lambda k, _: ~k.isin(list(drop))) if drop else base


def seeded_hash(unique: Column, seed: int) -> Column:
    """Text that orders rows at random, the same for the same seed and id."""
    return F.md5(F.concat_ws("/", unique.cast("string"), F.lit(str(seed))))


def allclose(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-5) -> Column:
    """|a - b| <= atol + rtol * |b|; false if one is missing."""
    return F.coalesce(F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b), F.lit(False))
