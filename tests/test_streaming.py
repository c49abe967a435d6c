"""Streams give what the batch operators give, file by file."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tablewright.operators.monitor import moments, welch
from tablewright.operators.ordering import identity_now, pick_per_key
from tablewright.sources.workspace import new_dir
from tablewright.streaming import jobs
from tests.conftest import rows

T0 = datetime(2024, 1, 1)
SCHEMA = "id bigint, k string, ts timestamp_ntz, v double"


def feed(spark, files):
    """One file per list of rows, read one file per micro-batch."""
    folder = new_dir(spark, "feed")
    for data in files:
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stored = spark.read.parquet(folder)
    return jobs.file_stream(spark, folder, stored.schema, files_per_batch=1), stored


def events(n=300, seed=8):
    rng = random.Random(seed)
    return [(i, rng.choice("aab"), T0 + timedelta(minutes=rng.randrange(5000)), float(rng.randrange(50))) for i in range(n)]


def test_materialize_with_a_late_older_row(spark):
    late = [(900, "a", T0, 1.0)]
    newest = [(901, "b", T0 + timedelta(days=30), 2.0)]
    stream, stored = feed(spark, [events()[:150], events()[150:], late, newest])
    out = jobs.stream_materialize(stream, ["k"], "ts", ["id"], new_dir(spark, "out"))
    want = pick_per_key(stored, ["k"], ["ts", "id"], "last")
    assert rows(out.select("k", "id")) == rows(want.select("k", "id"))


def test_identity_over_batches(spark):
    data = events()
    stream, stored = feed(spark, [data[:100], data[100:105], data[105:]])
    out = jobs.stream_identity(stream, ["k"], "v", "ts", "id", new_dir(spark, "out"), n=40)
    assert rows(out) == rows(identity_now(stored, ["k"], "v", "ts", "id", n=40))


def test_resume_processes_only_new_files(spark):
    data = events()
    folder, target = new_dir(spark, "feed"), new_dir(spark, "out")
    spark.createDataFrame(data[:200], SCHEMA).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    run = lambda: jobs.stream_identity(
        jobs.file_stream(spark, folder, schema, files_per_batch=1), ["k"], "v", "ts", "id", target, n=40
    )
    run()
    spark.createDataFrame(data[200:], SCHEMA).write.mode("append").parquet(folder)
    assert rows(run()) == rows(identity_now(spark.read.parquet(folder), ["k"], "v", "ts", "id", n=40))


def test_drift_per_window_and_late_rows(spark):
    day = lambda d: T0 + timedelta(days=d, hours=1)
    live = [(i, "a", day(i % 3), float(i % 7)) for i in range(60)]
    far = [(100, "a", day(20), 1.0), (101, "a", day(20), 3.0)]
    late = [(102, "a", day(0), 1000.0)]
    end = [(103, "a", day(40), 1.0)]
    stream, stored = feed(spark, [live, far, end, late])
    reference = spark.createDataFrame([(float(i % 5),) for i in range(50)], "v double")
    out = jobs.stream_drift(stream, reference, "ts", ["v"], "1 day", "2 days", new_dir(spark, "out"))
    got = {r["window_start"]: (r["n_live"], r["t"]) for r in out.collect()}
    fixed = moments(reference, ["v"]).select(
        "column_name", F.col("n").alias("n_ref"), F.col("mean").alias("mean_ref"), F.col("var").alias("var_ref")
    )
    batch = jobs.moments_by_window(stored.where("v < 1000"), "ts", ["v"], "1 day", "2 days")
    want = {r["window_start"]: (r["n_live"], r["t"]) for r in welch(batch.join(fixed, "column_name")).collect()}
    assert got == want and got[T0][0] == 20


def test_identity_state_of_late_missing_and_crowding_rows(spark):
    first = [(i, "a", T0 + timedelta(minutes=i), float(i)) for i in range(30)] + [(100, None, T0, 4.0), (101, "b", None, 8.0)]
    late = [(200 + i, "a", T0 - timedelta(minutes=i + 1), 1000.0) for i in range(5)]  # older than all of a full state
    some = [(300, "a", T0 + timedelta(minutes=12, seconds=30), 7.0), (301, "b", T0, None), (302, None, T0, 6.0)]
    stream, stored = feed(spark, [first, late, some])
    out = jobs.stream_identity(stream, ["k"], "v", "ts", "id", new_dir(spark, "out"), n=20)
    assert rows(out) == rows(identity_now(stored, ["k"], "v", "ts", "id", n=20))


def test_a_batch_writes_only_the_keys_it_touches(spark):
    from tablewright.streaming.log import BatchLog

    data = [(i, f"k{i % 50}", T0 + timedelta(minutes=i), float(i)) for i in range(400)]
    stream, stored = feed(spark, [data, [(900, "k7", T0 + timedelta(days=9), 5.0)], [(901, "new", T0, 5.0)]])
    target = new_dir(spark, "out")
    out = jobs.stream_identity(stream, ["k"], "v", "ts", "id", target, n=5)
    assert rows(out) == rows(identity_now(stored, ["k"], "v", "ts", "id", n=5))
    written = BatchLog(spark, target).read("means").groupBy("_batch").agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k"))
    assert rows(written) == [(0, 50, "k9"), (1, 1, "k7"), (2, 1, "new")]


def test_state_with_a_time_to_live_and_compaction(spark):
    data = events()
    stream, stored = feed(spark, [data[i : i + 100] for i in range(0, 300, 100)])
    out = jobs.stream_identity(stream, ["k"], "v", "ts", "id", new_dir(spark, "out"), n=40, ttl=timedelta(minutes=600), compact_every=2)
    newest = stored.groupBy("k").agg(F.max("ts").alias("m"))
    recent = stored.join(newest, "k").where("ts >= m - INTERVAL 600 MINUTES")
    assert rows(out) == rows(identity_now(recent, ["k"], "v", "ts", "id", n=40))


def test_materialized_changes_are_folded(spark):
    from tablewright.streaming.log import BatchLog

    data = events()
    stream, stored = feed(spark, [data[i : i + 50] for i in range(0, 300, 50)])
    target = new_dir(spark, "out")
    out = jobs.stream_materialize(stream, ["k"], "ts", ["id"], target, compact_every=2)
    assert rows(out.select("k", "id")) == rows(pick_per_key(stored, ["k"], ["ts", "id"], "last").select("k", "id"))
    entries = BatchLog(spark, target).entries()
    assert len(entries) <= 2 and entries[0]["base"]
