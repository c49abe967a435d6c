"""Readers and writers."""

from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.sources import tables as t
from tablewright.sources.workspace import new_dir, stage
from tests.conftest import rows


def test_pandas_file_with_nanoseconds_and_index(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    frame = pd.DataFrame(
        {"id": ["a", "b"], "day": pd.to_datetime(["2024-01-01 00:00:00.123456789", "1969-12-31 23:59:59.999999"])},
        index=[7, 3],
    )
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=True), tmp_path / "f.parquet", version="2.6")
    df = t.read_parquet(spark, str(tmp_path / "f.parquet"), ns_columns=["day"])
    assert df.columns == ["id", "day"]
    assert rows(df) == [
        ("a", datetime(2024, 1, 1, 0, 0, 0, 123456)), ("b", datetime(1969, 12, 31, 23, 59, 59, 999999)),
    ]


def test_csv_round_trip_of_awkward_text(spark):
    data = [(1, 'say "hi", you', 1.5, datetime(2024, 1, 2, 3, 4, 5, 6)), (2, "line\nbreak", None, None), (3, None, -0.1, None)]
    df = spark.createDataFrame(data, "id bigint, text string, x double, ts timestamp_ntz")
    path = new_dir(spark, "csv")
    t.write_csv(df, path)
    assert rows(t.read_csv(spark, path, df.schema, multi_line=True)) == rows(df)


def test_csv_bad_value_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,x\n1,notanumber\n")
    with pytest.raises(Exception):
        t.read_csv(spark, str(tmp_path / "bad.csv"), "id bigint, x double").collect()


def test_list_objects_reads_no_content(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.bin").write_bytes(b"123")
    (tmp_path / "two.txt").write_text("x")
    out = t.list_objects(spark, str(tmp_path), "*.bin")
    assert out.columns == ["path", "modificationTime", "length"]
    assert [r["length"] for r in out.collect()] == [3]


def test_projection_and_filter_reach_the_scan(spark):
    path = new_dir(spark, "p")
    spark.range(100).selectExpr("id", "id * 2 AS a", "id * 3 AS b").write.parquet(path)
    plan = t.read_parquet(spark, path, columns=["id", "a"]).where(F.col("a") > 10)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,10)" in text and "ReadSchema: struct<id:bigint,a:bigint>" in text


def test_stage_pins_rows(spark):
    df = stage(spark.range(5).withColumn("r", F.rand()))
    assert rows(df) == rows(df)


def test_partitioned_write_keeps_files_open(spark, tmp_path, monkeypatch):
    """Rows go to their folders unsorted, a file each and task; the session's own setting comes back."""
    from pyspark.sql import DataFrameWriter

    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        seen.append(spark.conf.get(name))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    before = spark.conf.get(name)
    folders = t.OPEN_FILES + 8  # more than are kept open
    df = spark.range(folders * 5).selectExpr("id", f"id % {folders} AS k").repartition(1)
    t.write_parquet(df, f"{tmp_path}/out", ["k"])
    assert seen == [str(t.OPEN_FILES)] and spark.conf.get(name) == before
    assert t.list_objects(spark, f"{tmp_path}/out", "*.parquet").count() == folders
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == [(i, i % folders) for i in range(folders * 5)]
