"""A snapshot sink: commits, appends, and jobs that fail."""

import os

import pytest
from pyspark.sql import functions as F

from tablewright.sources.snapshot import SnapshotWriter, Written, read_snapshot, write_snapshot
from tablewright.sources.workspace import new_dir
from tests.conftest import rows


def frame(spark, lo, hi):
    return spark.range(lo, hi, 1, 3).select("id", (F.col("id") * 2).cast("string").alias("s"), F.array("id").alias("a"))


def test_overwrite_append_and_old_versions(spark):
    path = new_dir(spark, "snapshot")
    write_snapshot(frame(spark, 0, 10), path)
    write_snapshot(frame(spark, 10, 20), path, append=True)
    assert rows(read_snapshot(spark, path)) == rows(frame(spark, 0, 20))
    write_snapshot(frame(spark, 5, 6), path)
    assert rows(read_snapshot(spark, path)) == rows(frame(spark, 5, 6))
    assert rows(read_snapshot(spark, path, 1)) == rows(frame(spark, 0, 10))


def test_an_aborted_job_leaves_the_table_readable(spark):
    path = new_dir(spark, "snapshot")
    write_snapshot(frame(spark, 0, 10), path)
    before = sorted(os.listdir(f"{path}/data"))
    broken = frame(spark, 0, 5000).withColumn("s", F.when(F.col("id") == 4321, F.raise_error(F.lit("stop"))).otherwise(F.col("s")))
    with pytest.raises(Exception, match="stop"):
        write_snapshot(broken, path)
    assert rows(read_snapshot(spark, path)) == rows(frame(spark, 0, 10))
    assert sorted(os.listdir(f"{path}/data")) == before and len(os.listdir(f"{path}/manifest")) == 1


def test_files_of_attempts_that_were_not_committed_are_not_read(spark):
    path = new_dir(spark, "snapshot")
    write_snapshot(frame(spark, 0, 10), path)
    job = next(iter(os.listdir(f"{path}/data")))
    frame(spark, 50, 60).coalesce(1).write.mode("append").parquet(f"{path}/data/{job}")  # as a second attempt would leave
    assert rows(read_snapshot(spark, path)) == rows(frame(spark, 0, 10))


def test_empty_tables_and_other_columns(spark):
    path = new_dir(spark, "snapshot")
    with pytest.raises(LookupError):
        read_snapshot(spark, path)
    write_snapshot(frame(spark, 0, 0), path)
    assert read_snapshot(spark, path).collect() == [] and read_snapshot(spark, path).columns == ["id", "s", "a"]
    write_snapshot(frame(spark, 0, 3), path, append=True)
    with pytest.raises(Exception, match="columns of the stored"):
        write_snapshot(frame(spark, 0, 3).drop("a"), path, append=True)
    assert read_snapshot(spark, path).count() == 3


def test_a_commit_without_files(spark):
    path = new_dir(spark, "snapshot")
    writer = SnapshotWriter(path, frame(spark, 0, 1).schema, append=True)
    writer.commit([None, Written(None, 0)])
    assert read_snapshot(spark, path).collect() == []
