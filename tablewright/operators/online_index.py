"""A serving table that answers a request from the few files that can hold its keys.

Rows are dealt into buckets by a hash of their keys, one file a bucket, sorted
by that hash inside and with a Bloom filter over it. An index beside the data
names the file of every bucket, its rows, and the sum and xor of their hashes.
A request reads the files of its own buckets, an upsert rewrites only the
buckets that it touches and refers to the files of the others, and two
versions are compared by their indexes before any row is read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.asof import asof_join
from tablewright.operators.features import FeatureService, FeatureView, OnlineTable
from tablewright.operators.incremental import upsert_unique
from tablewright.operators.ranges import bounded_parts, in_order
from tablewright.operators.slicing import join_null_safe
from tablewright.operators.versions import VersionedTable, diff, row_hash
from tablewright.sources.workspace import new_dir, stage

ROWS_PER_BUCKET = 250_000
GROWTH = 4  # a table that grew so much since its buckets were chosen gets new ones
# Up to so many keys of a request go into the scan's filter, where the files' Bloom filters and page statistics see them.
PUSHED_KEYS = 1000

HASH, BUCKET = "_key_hash", "_bucket"
INDEX_SCHEMA = "bucket int, file string, n_rows bigint, hash_sum decimal(38,0), hash_xor bigint, n_buckets int"


class IndexedTable(VersionedTable):
    """A versioned table of unique keys whose versions share the files of unchanged buckets.

    A manifest row's ``path`` is the version's index. Fingerprints are those
    of ``versions.fingerprint``: they are put together from the buckets'.
    """

    def __init__(self, spark: SparkSession, keys: Sequence[str], root: str | None = None, rows_per_bucket: int = ROWS_PER_BUCKET):
        super().__init__(spark, root)
        self.keys, self.rows_per_bucket = list(keys), rows_per_bucket

    # -- writing

    def _hash(self) -> Column:
        return F.xxhash64(*[F.col(f"`{k}`") for k in self.keys])

    def _placed(self, rows: DataFrame, layout: int, index: DataFrame | None = None) -> DataFrame:
        """``rows`` with the bucket of their keys."""
        return rows.withColumn(BUCKET, F.pmod(self._hash(), F.lit(layout)).cast("int"))

    _noted_names: tuple[str, ...] = ()

    def _noted(self) -> list[Column]:
        """Further columns of which the index keeps the least of each bucket."""
        return []

    def _put(self, placed: DataFrame, layout: int, tasks: int, rows_per_file: int) -> DataFrame:
        """Write rows with a bucket into files by it, of about so many rows; returns their index rows."""
        rows = placed.drop(BUCKET)
        names = rows.columns
        path = new_dir(self.spark, "buckets")
        (
            placed.withColumn(HASH, self._hash()).repartition(max(tasks, 1), BUCKET).sortWithinPartitions(BUCKET, HASH)
            .write.partitionBy(BUCKET)
            .option(f"parquet.bloom.filter.enabled#{HASH}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{HASH}", str(max(rows_per_file, self.rows_per_bucket)))
            .parquet(path)
        )
        stored = self.spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
        row = row_hash(rows.schema, names)
        hashed = stored.select(F.col(BUCKET).alias("bucket"), F.input_file_name().alias("file"), row.alias("h"), *self._noted())
        return hashed.groupBy("bucket", "file").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("h").cast("decimal(38,0)")).cast("decimal(38,0)").alias("hash_sum"),
            F.bit_xor("h").alias("hash_xor"), *[F.min(c).alias(c) for c in self._noted_names],
        ).withColumn("n_buckets", F.lit(layout))

    def _commit(self, index: DataFrame, schema: T.StructType, note: str, version: int) -> int:
        path = new_dir(self.spark, "index")
        names = [*T.StructType.fromDDL(INDEX_SCHEMA).names, *self._noted_names]
        index.select(*names).coalesce(1).write.parquet(path)  # one row per bucket
        total = self.spark.read.schema(INDEX_SCHEMA).parquet(path).agg(
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"), F.coalesce(F.sum("hash_sum"), F.lit(0)).cast("decimal(38,0)").cast("string").alias("s"),
            F.coalesce(F.bit_xor("hash_xor"), F.lit(0)).alias("x"),
        ).first()
        text = "/".join([",".join(sorted(schema.names)), str(total["n"]), total["s"], str(total["x"])])
        return self._append(version, hashlib.md5(text.encode()).hexdigest(), total["n"], path, note, schema.json())

    def write(self, df: DataFrame, note: str = "", after: Row | None = None) -> int:
        """Store ``df``, whose keys must be unique, as the new current version."""
        version = (after["version"] if after else self.newest()) + 1
        rows = stage(df, "snapshot")  # counted and written
        n = rows.count()
        n_buckets = bounded_parts(n, self.rows_per_bucket)
        written = self._put(self._placed(rows, n_buckets), n_buckets, n_buckets, n // n_buckets)
        return self._commit(written, df.schema, note, version)

    def upsert(self, delta: DataFrame, note: str = "", after: Row | None = None) -> int:
        """Replace or add the rows of ``delta`` (unique keys); only buckets that hold them are read and written."""
        current = after or self.entry()
        schema = T.StructType.fromJson(json.loads(current["schema"]))
        if set(delta.columns) != set(schema.names):
            raise ValueError(f"columns differ: {sorted(set(delta.columns) ^ set(schema.names))}")
        delta = stage(delta.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]), "delta")
        index = self.index(current)
        size = index.agg(F.max("n_buckets").alias("layout"), F.max("bucket").alias("last")).first()
        layout, buckets = size["layout"] or 1, (size["last"] or 0) + 1
        n = current["n_rows"] + delta.count()
        if bounded_parts(n, self.rows_per_bucket) > GROWTH * buckets:
            return self.write(upsert_unique(self.read_entry(current), delta, self.keys), note, current)
        touched = stage(self._placed(delta, layout, index).select(F.col(BUCKET).alias("bucket")).distinct(), "touched")
        merged = upsert_unique(self._rows(index.join(touched, "bucket", "left_semi"), schema), delta, self.keys)
        kept = index.join(touched, "bucket", "left_anti")
        written = self._put(self._placed(merged, layout, index), layout, touched.count(), n // buckets)
        return self._commit(kept.unionByName(written), schema, note, current["version"] + 1)

    # -- reading

    def index(self, entry: Row | None = None) -> DataFrame:
        """bucket, file, n_rows, hash_sum, hash_xor, n_buckets of a version, one row per bucket."""
        return self.spark.read.parquet((entry or self.entry())["path"])

    def _rows(self, index: DataFrame, schema: T.StructType, with_hash: bool = False) -> DataFrame:
        """The rows of the index's files; no folder is listed."""
        files = [r["file"] for r in index.select("file").collect()]  # one name per bucket
        stored = T.StructType([*schema.fields, *([T.StructField(HASH, T.LongType())] if with_hash else [])])
        if not files:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(*files)

    def read_entry(self, entry: Row) -> DataFrame:
        return self._rows(self.index(entry), T.StructType.fromJson(json.loads(entry["schema"])))

    def rows_for(self, request: DataFrame, entry: Row | None = None) -> DataFrame:
        """The stored rows of the request's keys (missing matches missing), read from their buckets alone."""
        entry = entry or self.entry()
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        typed = request.select(*[F.col(f"`{k}`").cast(schema[k].dataType).alias(k) for k in self.keys]).distinct()
        wanted = stage(typed.withColumn(HASH, self._hash()), "request")
        index = self.index(entry)
        layout = index.agg(F.max("n_buckets")).first()[0] or 1
        buckets = self._placed(wanted, layout, index).select(F.col(BUCKET).alias("bucket")).distinct()
        rows = self._rows(index.join(buckets, "bucket", "left_semi"), schema, with_hash=True)
        few = wanted.select(HASH).distinct().limit(PUSHED_KEYS + 1).collect()
        if len(few) <= PUSHED_KEYS:
            rows = rows.where(F.col(HASH).isin([r[0] for r in few]))
        return join_null_safe(rows, wanted.select(*self.keys), self.keys, "left_semi").select(*schema.names)

    def lookup(self, request: DataFrame, columns: Sequence[str], entry: Row | None = None) -> DataFrame:
        """Stored values for the given keys, a row for each row of the request; a miss is null."""
        entry = entry or self.entry()
        kinds = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(entry["schema"])).fields}
        asked = request.select(*[F.col(f"`{k}`").cast(kinds[k]).alias(k) for k in self.keys])
        found = self.rows_for(asked, entry).select(*self.keys, *columns)
        return join_null_safe(asked, found, self.keys).select(*self.keys, *columns)

    def changes(self, old: int, new: int) -> DataFrame:
        """Keys added, removed or changed between two versions; buckets with equal contents are not read."""
        a, b = self.entry(old), self.entry(new)
        one, two = self.index(a), self.index(b)
        schemas = [T.StructType.fromJson(json.loads(x["schema"])) for x in (a, b)]
        sizes = [x.agg(F.max("n_buckets")).first()[0] for x in (one, two)]
        if sizes[0] == sizes[1] and schemas[0] == schemas[1]:  # else the same key may lie in buckets of other numbers
            content = ["bucket", "n_rows", "hash_sum", "hash_xor"]
            one, two = one.join(two, content, "left_anti"), two.join(one, content, "left_anti")
        return diff(self._rows(one, schemas[0]), self._rows(two, schemas[1]), self.keys)


class RangedTable(IndexedTable):
    """An indexed table whose buckets are ranges of the first key, so that changes close together touch few of them.

    The index keeps the least key of each range. The first version's ranges
    come from a range exchange; later rows find theirs by an as-of join with
    the least keys, those below all of them in the first range. Rows of equal
    first key share a range, and a missing one comes first.
    """

    _noted_names = ("low",)

    def _noted(self) -> list[Column]:
        return [F.col(f"`{self.keys[0]}`").alias("low")]

    def write(self, df: DataFrame, note: str = "", after: Row | None = None) -> int:
        version = (after["version"] if after else self.newest()) + 1
        ordered = in_order(df, [self.keys[0]], self.rows_per_bucket)
        size = ordered.agg(F.max("_part").alias("last"), F.count(F.lit(1)).alias("n")).first()
        parts = (size["last"] or 0) + 1
        placed = ordered.withColumn(BUCKET, F.col("_part").cast("int")).drop("_part", "_pos")
        # ranges of another version have another number, as their bounds differ
        return self._commit(self._put(placed, version, parts, size["n"] // parts), df.schema, note, version)

    def _placed(self, rows: DataFrame, layout: int, index: DataFrame | None = None) -> DataFrame:
        first = self.keys[0]
        bounds = index.where(F.col("low").isNotNull()).select(F.col("low").alias("_low"), F.col("bucket").alias("_of"))
        least = index.agg(F.min("bucket")).first()[0] or 0
        found = asof_join(rows, bounds, [], first, "_low", ["_of"], ["_of"])
        return found.withColumn(BUCKET, F.coalesce("_of", F.lit(least)).cast("int")).drop("_of")


class IndexedOnlineTable(OnlineTable):
    """The latest feature row per key in an indexed table: lookups and refreshes read and write their buckets alone."""

    def __init__(self, spark: SparkSession, view: FeatureView, root: str | None = None, rows_per_bucket: int = ROWS_PER_BUCKET):
        self.view = view
        self.store = IndexedTable(spark, view.keys, root, rows_per_bucket)

    def materialize_incremental(self, end) -> DataFrame:
        """Bring the table from its mark up to ``end``; a newer row is never replaced by an older one."""
        from tablewright.operators.features import _ntz

        current = self.store.entry()
        recent = self._latest(_ntz(self.mark()), end)
        self.store.upsert(recent, note=end.isoformat(sep=" "), after=current)
        return self.read()

    def features(self, keys: DataFrame, service: FeatureService | None = None) -> DataFrame:
        names = service.features if service else [f.name for f in self.view.schema.fields]
        return self.store.lookup(keys, names)
