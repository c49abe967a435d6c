"""A serving table behind Spark's writer interface: tasks write files, one commit makes them the table.

``df.write.format("tablewright_snapshot").option("path", ...)`` writes each
task's rows to a file named after its attempt. The tasks report their files,
and the driver's commit names them in a new manifest, which appears by one
rename. A job that fails or is ended before that leaves the table as it was,
and what its tasks wrote is removed; a task that ran twice is named once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "tablewright_snapshot"


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: a file, if it had rows, and how many."""

    file: str | None
    rows: int


def _system(path: str) -> tuple[fs.FileSystem, str]:
    system, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return system, inner.rstrip("/")


def _versions(system: fs.FileSystem, root: str) -> list[str]:
    found = system.get_file_info(fs.FileSelector(f"{root}/manifest", allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.endswith(".json"))


def _manifest(system: fs.FileSystem, root: str) -> dict | None:
    versions = _versions(system, root)
    if not versions:
        return None
    with system.open_input_stream(versions[-1]) as f:
        return json.loads(f.read())


class SnapshotWriter(DataSourceArrowWriter):
    """One write of a snapshot; ``append`` keeps the files of the version before."""

    def __init__(self, path: str, schema: StructType, append: bool):
        self.path, self.columns, self.append = path, schema.json(), append
        self.job = uuid.uuid4().hex

    def _folder(self, root: str) -> str:
        return f"{root}/data/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _system(self.path)
        context = TaskContext.get()
        system.create_dir(self._folder(root))
        file = f"{self._folder(root)}/part-{context.partitionId():05d}-{context.taskAttemptId()}.parquet"
        rows, writer = 0, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    writer = pq.ParquetWriter(file, batch.schema, filesystem=system, compression="snappy")
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written(file if rows else None, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = _system(self.path)
        before = _manifest(system, root) or {"version": 0, "files": [], "rows": 0}
        if self.append and before["files"] and before["schema"] != self.columns:
            self.abort(messages)
            raise ValueError("an appended table must have the columns of the stored one")
        files = [m.file for m in messages if m and m.file]
        rows = sum(m.rows for m in messages if m)
        if self.append:
            files, rows = before["files"] + files, before["rows"] + rows
        version = before["version"] + 1
        body = json.dumps({"version": version, "files": files, "rows": rows, "schema": self.columns})
        system.create_dir(f"{root}/manifest")
        draft = f"{root}/manifest/.{self.job}"
        with system.open_output_stream(draft) as f:
            f.write(body.encode())
        system.move(draft, f"{root}/manifest/{version:010d}.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = _system(self.path)
        if system.get_file_info(self._folder(root)).type == fs.FileType.Directory:
            system.delete_dir(self._folder(root))


class SnapshotSource(DataSource):
    """The writer side of a snapshot table; it is read by ``read_snapshot``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> SnapshotWriter:
        if "path" not in self.options:
            raise ValueError("a snapshot needs the option path")
        return SnapshotWriter(self.options["path"], schema, not overwrite)


def write_snapshot(df: DataFrame, path: str, append: bool = False) -> None:
    """Make ``df`` the table at ``path``, or add it to the table there."""
    df.sparkSession.dataSource.register(SnapshotSource)
    df.write.format(FORMAT).option("path", path).mode("append" if append else "overwrite").save()


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table of the newest manifest, or of an older one, read by Spark from the files it names."""
    system, root = _system(path)
    versions = _versions(system, root)
    wanted = versions[-1:] if version is None else [v for v in versions if v.endswith(f"/{version:010d}.json")]
    if not wanted:
        raise LookupError(f"no version {version or ''} under {path}")
    with system.open_input_stream(wanted[0]) as f:
        manifest = json.loads(f.read())
    schema = StructType.fromJson(json.loads(manifest["schema"]))
    if not manifest["files"]:
        return spark.createDataFrame([], schema)
    scheme = path.split("://")[0] + "://" if "://" in path else "file:"
    return spark.read.schema(schema).parquet(*[f"{scheme}{f}" for f in manifest["files"]])
