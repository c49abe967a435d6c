"""Tables kept by a stream: what each batch brought, one commit for all of a batch's tables, and compaction.

A batch writes its tables into folders of its own and becomes visible when one
small manifest file lands that names them all, so either all tables have the
batch or none. A batch that comes again is known by its id and changes
nothing; one that died before its commit is written anew, and what it left
behind is named nowhere. Compaction folds the batches of a table into one base
and opens a new manifest that begins with it: readers open the base and the
batches after it, and never list the manifests or folders before. A reader
that has begun keeps its files, because none is ever changed or removed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.sources.workspace import local_table, new_dir

BATCH = "_batch"
ENTRIES = "name string, batch_id bigint, path string, schema string, base boolean"


class BatchLog:
    """Named tables below ``root``, written batch by batch. One writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or new_dir(spark, "log")

    def _path(self, path: str):
        jvm = self.spark._jvm
        found = jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _epochs(self) -> list[int]:
        """Numbers of the manifests whose first commit is complete, newest last."""
        path, fs = self._path(f"{self.root}/manifest")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        done = [n for n in names if fs.exists(self._path(f"{self.root}/manifest/{n}/_SUCCESS")[0])]
        return sorted(int(n) for n in done)

    def entries(self) -> list[Row]:
        """What the newest manifest names: a base at most and the batches after it, per table."""
        epochs = self._epochs()
        if not epochs:
            return []
        rows = self.spark.read.schema(ENTRIES).parquet(f"{self.root}/manifest/{epochs[-1]:010d}")
        return rows.orderBy("name", "batch_id").collect()

    def _append(self, rows: list[tuple], epoch: int) -> None:
        table = local_table(self.spark, rows, ENTRIES).coalesce(1)  # one file, so it lands whole or not at all
        table.write.mode("append").parquet(f"{self.root}/manifest/{epoch:010d}")

    def last_batch(self) -> int:
        """The id of the newest committed batch, -1 before the first."""
        return max((e["batch_id"] for e in self.entries()), default=-1)

    def stage(self, name: str, rows: DataFrame, batch_id: int) -> tuple:
        """Write one table of a batch; it is not visible before ``commit``."""
        path = f"{self.root}/data/{name}/{batch_id}-{new_dir(self.spark, 'x').rsplit('-', 1)[1]}"
        marked = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        marked.write.parquet(path)
        return name, batch_id, path, marked.schema.json(), False

    def read_staged(self, staged: tuple) -> DataFrame:
        return self.spark.read.schema(_schema(staged[3])).parquet(staged[2]).drop(BATCH)

    def commit(self, *staged: tuple) -> None:
        """Make the staged tables of a batch visible, all at once."""
        self._append(list(staged), (self._epochs() or [0])[-1])

    def write(self, batch_id: int, tables: Mapping[str, DataFrame]) -> bool:
        """Write and commit the tables of a batch; False, and nothing done, if the batch was committed before."""
        if batch_id <= self.last_batch():
            return False
        self.commit(*[self.stage(name, rows, batch_id) for name, rows in tables.items()])
        return True

    def read(self, name: str, after: int | None = None) -> DataFrame:
        """All rows of a table with the batch they came from; ``after`` leaves earlier batches unread."""
        entries = [e for e in self.entries() if e["name"] == name]
        if not entries:
            raise LookupError(f"no table {name!r} under {self.root}")
        schema = _schema(entries[-1]["schema"])
        wanted = [e["path"] for e in entries if after is None or e["batch_id"] > after]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*wanted)
        return rows if after is None else rows.where(F.col(BATCH) > after)

    def compact(self, folds: Mapping[str, Callable[[DataFrame], DataFrame]]) -> None:
        """Fold the batches of some tables into a base each; other tables keep their batches.

        A fold gets all rows of a table with ``_batch`` and returns those to keep, in the same columns.
        """
        entries = self.entries()
        if not entries:
            return
        rows = [tuple(e) for e in entries if e["name"] not in folds]
        for name, fold in folds.items():
            own = [e for e in entries if e["name"] == name]
            if not own:
                continue
            all_rows = self.read(name)
            path = f"{self.root}/data/{name}/base-{new_dir(self.spark, 'x').rsplit('-', 1)[1]}"
            fold(all_rows).select(*all_rows.columns).write.parquet(path)
            rows.append((name, own[-1]["batch_id"], path, all_rows.schema.json(), True))
        self._append(rows, self._epochs()[-1] + 1)

    def batches_since_base(self, name: str) -> int:
        return sum(1 for e in self.entries() if e["name"] == name and not e["base"])


def _schema(text: str) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(text))
