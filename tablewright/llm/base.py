"""Registry of the corpus queries, and what they share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Arrow batches handed to a task's Python code stay below this many bytes, so
# that a run of long documents does not fill the worker.
BATCH_BYTES = 16 << 20


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    return spark


@contextmanager
def batches_below(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs run inside hand Arrow batches below so many bytes to Python."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(size))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``, with the SQL whose rows it must equal where there is one."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__ = run.__qualname__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go, whose tables nobody holds any more.

    They are removed when the driver collects its garbage, which by itself it
    does too rarely for a job of many steps.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def keep_rows(docs: DataFrame, id_column: str, mark: Column, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id and ``mark`` are among ``keys`` (id, mark); of rows equal in both, one.

    A missing id matches a missing one. One shuffle of the rows serves both.
    """
    wanted = keys.toDF("__key_id", "__key_mark").distinct()
    filled = F.coalesce(F.col("__key_id").cast("string"), F.lit("-"))
    wanted = wanted.select(filled.alias("__row_id"), F.col("__key_mark").alias("__row_mark"))
    marked = docs.withColumns(
        {"__row_id": F.coalesce(F.col(id_column).cast("string"), F.lit("-")), "__row_mark": mark}
    )
    kept = marked.join(wanted, ["__row_id", "__row_mark"], "left_semi")
    return kept.dropDuplicates(["__row_id", "__row_mark"]).select(*docs.columns)
