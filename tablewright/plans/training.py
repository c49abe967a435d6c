"""From rankings and properties to a scaled, split training table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.columns import Rule, require_valid
from tablewright.operators.joins import merge
from tablewright.operators.ordering import sorted_codes
from tablewright.operators.prep import MinMax, encode_labels, split
from tablewright.operators.slicing import ROWS_PER_SLICE, pinned
from tablewright.sources.workspace import stage


@dataclass(frozen=True)
class TrainingSet:
    table: DataFrame  # unique id, label, code, split, scaled features
    codes: DataFrame  # label, code
    scaler: MinMax


def training_set(
    rankings: DataFrame, properties: DataFrame, on: str, label: str, features: Sequence[str], unique: str,
    rules: Sequence[Rule] = (), rows_per_slice: int = ROWS_PER_SLICE,
) -> TrainingSet:
    """Merge, check, drop incomplete rows, encode, split and scale.

    The scaler sees train rows only. The joined table is written once; the
    passes that look for the split's boundaries and fit the scaler read it.
    """
    joined = merge(rankings, properties, on, "left").select(unique, label, *features).dropna("any")
    joined = stage(joined, "training-set")
    if rules:
        require_valid(joined, rules)
    codes = pinned(sorted_codes(joined, label))
    parts = split(joined, [unique], label, unique, rows_per_slice=rows_per_slice)
    parts = encode_labels(parts, label, codes)
    scaler = MinMax.fit(parts.where(F.col("split") == "train"), features)
    return TrainingSet(scaler.transform(parts), codes, scaler)
