"""Encoding, splitting, shuffling and scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.scalars import seeded_hash
from tablewright.operators.joins import require_unique
from tablewright.operators.ordering import sorted_codes
from tablewright.operators.slicing import ROWS_PER_SLICE, join_null_safe, pinned, rank_cutoffs, row_number
from tablewright.sources.workspace import local_table

# Fixed values of the training set: share of test rows, share of validation
# rows among the rest, seed, batch size.
TEST_PERCENT = 20
VAL_PERCENT = 20
SEED = 42
BATCH = 32


def encode_labels(df: DataFrame, column: str, codes: DataFrame | None = None, name: str = "code") -> DataFrame:
    """Add the class number of a label; numbers follow the sorted labels."""
    table = codes if codes is not None else pinned(sorted_codes(df, column))
    table = table.select(F.col("label").alias(column), F.col("code").alias(name))
    return join_null_safe(df, table, [column])


def one_hot(code: Column, n_classes: int) -> Column:
    """Class number to a 0/1 array over all classes."""
    return F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda i: (i == code).cast("double"))


def split_ordered(
    df: DataFrame, order_by: Sequence[str], test_percent: int = TEST_PERCENT, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add ``is_test`` for the last rows in the given order.

    The number of test rows is rounded up. Only the boundary row is looked
    for; the table is then compared with it as it is read, without a shuffle.
    """
    def train_rows(n: Column) -> Column:
        return n - F.floor((n * test_percent + 99) / 100)

    types = {c: df.schema[c].dataType for c in order_by}
    # times travel as text: a driver's own time zone would shift them
    carried = [c for c in order_by if isinstance(types[c], T.DatetimeType)]
    edges = rank_cutoffs(df, [], order_by, train_rows, rows_per_slice=rows_per_slice).select("_cutoff.*")
    found = edges.withColumns({c: F.col(c).cast("string") for c in carried}).collect()  # one row
    if not found:
        return df.withColumn("is_test", F.lit(True))
    last_train = F.struct(*[F.lit(found[0][c]).cast(types[c]).alias(c) for c in order_by])
    return df.withColumn("is_test", F.struct(*order_by) > last_train)


def split_stratified(
    df: DataFrame, label: str, unique: str, percent: int = VAL_PERCENT, seed: int = SEED, name: str = "is_val",
    among: Column | None = None, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Mark a seeded share of the rows of every class.

    Rows are ordered by a hash of their id and the seed; the first
    round(percent) of each class are taken. The boundary hash of each class
    is found from counts, then compared with as the table is read. ``among``
    restricts the draw to some rows.
    """
    def taken(n: Column) -> Column:
        return F.floor((n * percent + 50) / 100)

    pool = df if among is None else df.where(among)
    hashed = pool.select(label, F.col(unique).alias("_id"), seeded_hash(F.col(unique), seed).alias("_hash"))
    edges = rank_cutoffs(hashed, [label], ["_hash", "_id"], taken, rows_per_slice=rows_per_slice)
    joined = join_null_safe(df, pinned(edges), [label])
    here = F.struct(seeded_hash(F.col(unique), seed).alias("_hash"), F.col(unique).alias("_id"))
    drawn = F.coalesce(here <= F.col("_cutoff"), F.lit(False))
    if among is not None:
        drawn = drawn & among
    return joined.withColumn(name, drawn).drop("_cutoff")


def split(
    df: DataFrame, order_by: Sequence[str], label: str, unique: str, seed: int = SEED,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``split``: the last rows are ``test``, a stratified share of the rest ``val``, else ``train``."""
    marked = split_ordered(df, order_by, rows_per_slice=rows_per_slice)
    marked = split_stratified(
        marked, label, unique, seed=seed, among=~F.col("is_test"), rows_per_slice=rows_per_slice
    )
    part = F.when(F.col("is_test"), "test").when(F.col("is_val"), "val").otherwise("train")
    return marked.withColumn("split", part).drop("is_test", "is_val")


def shuffled(
    df: DataFrame, unique: str, seed: int = SEED, batch: int = BATCH, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """A repeatable random order: adds ``position`` from 0 and its ``batch``."""
    hashed = df.withColumn("_hash", seeded_hash(F.col(unique), seed))
    numbered = row_number(hashed, [], ["_hash", unique], name="_at", rows_per_slice=rows_per_slice)
    position = F.col("_at") - 1
    return numbered.withColumn("position", position).withColumn(
        "batch", F.floor(position / batch)
    ).drop("_hash", "_at")


@dataclass(frozen=True)
class MinMax:
    """Smallest and largest value per feature, as fitted."""

    bounds: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> MinMax:
        """One aggregate; only its single row reaches the driver."""
        parts = []
        for c in columns:
            v = F.col(c).cast("double")
            v = F.when(~F.isnan(v), v)
            parts += [F.min(v), F.max(v)]
        row = df.agg(*parts).first()
        return cls({c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)})

    def scaled(self, name: str) -> Column:
        """(x - min) / (max - min), not clipped; a constant feature becomes 0."""
        low, high = self.bounds[name]
        if low is None:
            return F.lit(None).cast("double")
        return (F.col(name).cast("double") - F.lit(low)) / F.lit((high - low) or 1.0)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.scaled(c) for c in self.bounds})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: F.col(c) * F.lit((high - low) or 1.0) + F.lit(low) for c, (low, high) in self.bounds.items()}
        )

    @classmethod
    def load(cls, stored: DataFrame) -> MinMax:
        """What ``table`` wrote: one row per feature."""
        return cls({r["feature"]: (r["min"], r["max"]) for r in stored.select("feature", "min", "max").collect()})

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, low, high) for c, (low, high) in self.bounds.items()]
        return local_table(spark, rows, "feature string, min double, max double")


def compare_predictions(
    a: DataFrame, b: DataFrame, keys: Sequence[str], values: str, rtol: float = 1e-5, atol: float = 1e-5
) -> DataFrame:
    """Rows whose two arrays are not equal within tolerance: keys, position, a, b.

    An element missing on one side counts as different. A row that only one
    side has is reported even if its array is empty or missing, and so is a
    missing array beside one that is there: with a missing position if there
    is no element to show. Keys must be unique on both sides. Arrays are
    compared inside the row; only elements that differ become rows.
    """
    a, b = require_unique(a, keys), require_unique(b, keys)
    left = a.select(*keys, F.col(values).alias("_a"), F.lit(True).alias("_in_a"))
    right = b.select(*[F.col(k).alias(f"_right_{k}") for k in keys], F.col(values).alias("_b"), F.lit(True).alias("_in_b"))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    none = F.array().cast("array<double>")
    both = left.join(right, condition, "full_outer").select(
        *[F.when(F.col("_in_a"), F.col(k)).otherwise(F.col(f"_right_{k}")).alias(k) for k in keys],
        F.coalesce("_a", none).alias("_a"),
        F.coalesce("_b", none).alias("_b"),
        (F.col("_in_a").isNull() | F.col("_in_b").isNull() | (F.col("_a").isNull() != F.col("_b").isNull())).alias("_one_sided"),
    )
    zipped = both.select(*keys, "_one_sided", F.posexplode_outer(F.arrays_zip("_a", "_b")).alias("position", "pair"))
    x, y = F.col("pair._a"), F.col("pair._b")
    close = F.coalesce(F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y), F.lit(False))
    shown = F.when(F.col("position").isNull(), F.col("_one_sided")).otherwise(~close)
    return zipped.where(shown).select(*keys, "position", x.alias("a"), y.alias("b"))
