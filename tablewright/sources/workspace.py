"""The shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder
    would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tablewright-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_root(spark)}/tablewright/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage and pins the rows: later passes neither recompute the
    plan nor see another evaluation of it, and losing an executor costs
    nothing that was already written. These tables stay while the session
    runs, so they are written densely.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A handful of driver-side rows as a table whose size the optimiser knows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    records = [dict(zip(schema.names, r)) for r in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema)
