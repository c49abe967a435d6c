"""Content fingerprints and versioned tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.sources.workspace import local_table, new_dir

MANIFEST_SCHEMA = (
    "version bigint, fingerprint string, n_rows bigint, path string, note string, "
    "schema string, created timestamp_ntz"
)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that identifies the content of a table.

    Sum and xor of the row hashes do not depend on row order or partitioning,
    and both combine on the map side, so one number per task is shuffled.
    The sum sees duplicates, which cancel out in the xor.
    """
    return df.agg(*_content(df.schema)).withColumn("fingerprint", F.md5(_mark(df.columns)))


def row_hash(schema: T.StructType, columns: Sequence[str]) -> Column:
    """A hash of the named columns of a row.

    The engine's hash skips missing values, so each column goes in with a flag
    that says whether it is there; a value that moves between columns changes
    the hash. Maps are hashed as their entries in the order of the keys.
    """
    parts: list[Column] = []
    for name in sorted(columns):
        value = _hashable(F.col(f"`{name}`"), schema[name].dataType)
        parts += [F.col(f"`{name}`").isNull(), value]
    return F.xxhash64(*parts)


def _hashable(value: Column, kind: T.DataType) -> Column:
    """The value with maps, at any depth, as lists of entries; missing parts of it are marked."""
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_entries(value), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        return F.transform(entries, lambda e: F.struct(e["key"], e["value"].isNull(), _hashable(e["value"], kind.valueType)))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: F.struct(x.isNull(), _hashable(x, kind.elementType)))
    if isinstance(kind, T.StructType):
        return F.struct(*[part for f in kind.fields for part in (value[f.name].isNull(), _hashable(value[f.name], f.dataType))])
    return value


def _content(schema: T.StructType) -> list[Column]:
    """Count, sum and xor of the row hashes, columns taken by name."""
    row = row_hash(schema, schema.names)
    zero = F.lit(0).cast("decimal(38,0)")
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(row.cast("decimal(38,0)")), zero).cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("hash_xor"),
    ]


def _mark(columns: Sequence[str]) -> Column:
    return F.concat_ws("/", F.lit(",".join(sorted(columns))), F.col("n_rows"), F.col("hash_sum"), F.col("hash_xor"))


class VersionedTable:
    """A table whose every state is kept under its own path.

    Data files are never overwritten: a new state is written to a new folder
    and becomes current when its manifest row lands. A job that dies halfway
    leaves the previous version in force. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or new_dir(spark, "versions")

    @property
    def _manifest(self) -> str:
        return f"{self.root}/manifest"

    def history(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(self._manifest)

    def entry(self, version: int | None = None) -> Row:
        """The manifest row of a version, by default of the current one."""
        rows = self.history()
        if version is not None:
            rows = rows.where(F.col("version") == version)
        # one small row, whatever the size of the table
        entry = rows.orderBy(F.desc("version")).limit(1).collect()
        if not entry:
            raise LookupError(f"no version {version} under {self.root}")
        return entry[0]

    def _append(self, version: int, mark: str, n_rows: int, path: str, note: str, schema: str) -> int:
        row = local_table(
            self.spark,
            [(version, mark, n_rows, path, note, schema)],
            "version bigint, fingerprint string, n_rows bigint, path string, note string, schema string",
        ).withColumn("created", F.localtimestamp())
        row.coalesce(1).write.mode("append").parquet(self._manifest)
        return version

    def newest(self) -> int:
        """The number of the current version, 0 if there is none."""
        try:
            return self.entry()["version"]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        except LookupError:
            pass
        return 0

    def write(self, df: DataFrame, note: str = "", after: Row | None = None) -> int:
        """Store ``df`` as the new current version; returns its number.

        The first version is 1, later ones follow the newest. ``df`` may read
        the current version: its files stay as they are. ``after`` is the
        current entry where the caller has it at hand.
        """
        version = (after["version"] if after else self.newest()) + 1
        path = new_dir(self.spark, "data")
        seen = Observation()
        # hashed while it is written, so the data is not read a second time
        df.observe(seen, *_content(df.schema)).write.parquet(path)
        content = seen.get
        text = "/".join([",".join(sorted(df.columns)), *(str(content[c]) for c in ("n_rows", "hash_sum", "hash_xor"))])
        mark = hashlib.md5(text.encode()).hexdigest()
        return self._append(version, mark, content["n_rows"], path, note, df.schema.json())

    def create(self, df: DataFrame, note: str = "") -> VersionedTable:
        self.write(df, note)
        return self

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of ``version``, by default the current one."""
        return self.read_entry(self.entry(version))

    def read_mark(self, mark: str) -> DataFrame:
        """The newest version whose content has this fingerprint."""
        found = self.history().where(F.col("fingerprint") == mark).orderBy(F.desc("version")).limit(1).collect()
        if not found:
            raise LookupError(f"no version with fingerprint {mark} under {self.root}")
        return self.read_entry(found[0])

    def read_entry(self, entry: Row) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(entry["path"])

    def revert(self, version: int, note: str = "") -> int:
        """Make an old version current again, as a new version without a copy."""
        old = self.entry(version)
        return self._append(
            self.entry()["version"] + 1,
            old["fingerprint"],
            old["n_rows"],
            old["path"],
            note or f"revert to {version}",
            old["schema"],
        )

    def rename_column(self, old: str, new: str) -> int:
        """Rename a column of the current version in place."""
        current = self.entry()
        renamed = self.read_entry(current).withColumnRenamed(old, new)
        return self.write(renamed, note=f"rename {old} to {new}", after=current)


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed between two states.

    Rows are reduced to (key, row hash) before the shuffle, so the join moves
    a few bytes per row whatever the width of the table. Keys must be unique.
    """
    def hashed(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in sorted(df.columns) if c not in keys]
        return df.select(
            *[F.col(k).alias(f"{name}_{k}") for k in keys],
            (row_hash(df.schema, rest) if rest else F.lit(0)).alias(f"{name}_hash"),
            F.lit(True).alias(f"{name}_here"),
        )

    a, b = hashed(old, "old"), hashed(new, "new")
    condition = None
    for k in keys:
        same = F.col(f"old_{k}").eqNullSafe(F.col(f"new_{k}"))
        condition = same if condition is None else condition & same
    joined = a.join(b, condition, "full_outer")
    change = (
        F.when(F.col("old_here").isNull(), "added")
        .when(F.col("new_here").isNull(), "removed")
        .when(F.col("old_hash") != F.col("new_hash"), "changed")
    )
    return joined.select(
        *[F.coalesce(f"new_{k}", f"old_{k}").alias(k) for k in keys], change.alias("change")
    ).where(F.col("change").isNotNull())
