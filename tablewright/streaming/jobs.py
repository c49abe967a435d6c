"""Continuous drift, identity and materialisation.

Each job writes what changed in a micro-batch under the batch's id: drift to a
folder of that name, which a repeated batch overwrites, identity and
materialisation to a log that knows its batches and folds them (see ``log``).
The readers return the newest value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablewright.operators.monitor import moments, welch
from tablewright.operators.ordering import pick_per_key
from tablewright.operators.slicing import join_null_safe, micros, pinned
from tablewright.streaming.log import BATCH, BatchLog
from tablewright.streaming.push import COMPACT_EVERY
from tablewright.streaming.state import NewestRows, newest_of_batch


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files of a folder as a stream, as they arrive."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def run_available(
    df: DataFrame, out: str, mode: str, batch: Callable[[DataFrame, int], DataFrame] | None = None
) -> StreamingQuery:
    """Process all that is there and stop; results go to ``out``, progress to a checkpoint beside it."""

    def write(rows: DataFrame, batch_id: int) -> None:
        result = batch(rows, batch_id) if batch else rows
        result.write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")

    query = (
        df.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_logged(
    df: DataFrame, out: str, mode: str, name: str, fold: Callable[[DataFrame], DataFrame], compact_every: int
) -> BatchLog:
    """Process all that is there and stop; each batch is committed to a log, which is folded now and then."""
    log = BatchLog(df.sparkSession, out)

    def write(rows: DataFrame, batch_id: int) -> None:
        if log.write(batch_id, {name: rows}) and log.batches_since_base(name) >= compact_every:
            log.compact({name: fold})

    query = (
        df.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return log


def changes(spark: SparkSession, out: str) -> DataFrame:
    """All changes written so far, with the batch they came from."""
    return spark.read.option("basePath", f"{out}/data").parquet(f"{out}/data").withColumn(
        "batch_id", F.col("batch_id").cast("bigint")
    )


def stream_materialize(
    events: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[str], out: str, compact_every: int = COMPACT_EVERY
) -> DataFrame:
    """Keep the newest row per key by event time; a late older row changes nothing.

    The state holds one row per key, and rows combine before they reach it.
    Every so many batches the changes are folded into one base, so a reader
    opens that and the batches after it.
    """
    rest = [c for c in events.columns if c not in keys]
    newest = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts, *tie_break)).alias("_row"))
    flat = newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    log = run_logged(flat, out, "update", "newest", lambda rows: pick_per_key(rows, keys, [BATCH], "last"), compact_every)
    return pick_per_key(log.read("newest"), keys, [BATCH], "last").drop(BATCH)


def stream_drift(
    live: DataFrame, reference: DataFrame, ts: str, columns: Sequence[str], window: str, watermark: str, out: str
) -> DataFrame:
    """Mean shift of each time window of live rows against fixed reference rows.

    Rows later than the watermark are dropped. Only a window's moments are
    kept as state; the reference is read once, for one row of moments per
    column.
    """
    fixed = pinned(moments(reference, columns).select(
        "column_name", F.col("n").alias("n_ref"), F.col("mean").alias("mean_ref"), F.col("var").alias("var_ref")
    ))
    by_window = moments_by_window(live, ts, columns, window, watermark)

    def batch(rows: DataFrame, _: int) -> DataFrame:
        return welch(join_null_safe(rows, fixed, ["column_name"], "inner"))

    run_available(by_window, out, "update", batch)
    latest = pick_per_key(changes(live.sparkSession, out), ["window_start", "column_name"], ["batch_id"], "last")
    return latest.drop("batch_id")


def moments_by_window(df: DataFrame, ts: str, columns: Sequence[str], window: str, watermark: str) -> DataFrame:
    """n, mean and variance of live rows per window and column, as ``*_live``."""
    timed = df.withColumn("_at", F.col(ts).cast("timestamp"))  # watermarks need a zoned time
    marked = timed.withWatermark("_at", watermark) if df.isStreaming else timed
    by = marked.withColumn("_w", F.window("_at", window))
    long = moments(by, columns, ["_w"])
    return long.select(
        F.col("_w.start").cast("timestamp_ntz").alias("window_start"), "column_name", F.col("n").alias("n_live"),
        F.col("mean").alias("mean_live"), F.col("var").alias("var_live"),
    )


def stream_identity(
    events: DataFrame, keys: Sequence[str], value: str, ts: str, unique: str, out: str, n: int = 256,
    ttl: timedelta | None = None, compact_every: int = COMPACT_EVERY,
) -> DataFrame:
    """Mean over the newest ``n`` rows of each key, after every batch.

    A key's newest rows lie in ``n`` slots of the state store; a row that
    enters takes the slot of the oldest, so a batch reads and writes the keys
    it touches and, of those, the rows that change. Rows are cut to the newest
    ``n`` per key before they are shuffled. With a ``ttl``, rows so much older
    than their key's newest one are forgotten. Every so many batches the means
    are folded.
    """
    fields = events.select(F.col(unique).alias("_unique"), F.col(value).cast("double").alias("_value")).schema.fields
    flat = events.select(*keys, micros(ts).alias("_at"), F.col(unique).alias("_unique"), F.col(value).cast("double").alias("_value"))
    kept = flat.mapInPandas(newest_of_batch(list(keys), n), flat.schema)
    means = kept.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=NewestRows(list(keys), T.StructType([T.StructField("_at", T.LongType()), *fields]), n, ttl),
        outputStructType=T.StructType(
            [*flat.select(*keys).schema.fields, T.StructField("mean_value", T.DoubleType()), T.StructField("n", T.LongType())]
        ),
        outputMode="update",
        timeMode="none",
    )
    spark = events.sparkSession
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        log = run_logged(means, out, "update", "means", lambda rows: pick_per_key(rows, keys, [BATCH], "last"), compact_every)
    finally:
        if before is None:
            spark.conf.unset(provider)
        else:
            spark.conf.set(provider, before)
    return pick_per_key(log.read("means"), keys, [BATCH], "last").drop(BATCH)
