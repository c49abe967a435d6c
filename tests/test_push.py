"""Push sources and logs: batches that come again, die halfway, arrive late, and are folded."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.ordering import pick_per_key
from tablewright.streaming.log import BATCH, BatchLog
from tablewright.streaming.push import push_source
from tests.conftest import rows
from tests.test_streaming import SCHEMA, T0, events, feed

FEATURES = T.StructType([T.StructField("v", T.DoubleType())])


def source(spark, **options):
    return push_source(spark, "live", ["k"], "ts", "id", FEATURES, **options)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def state(s):
    return rows(s.history().select("id", "k", "ts", "v")), rows(s.online().select("id", "k", "ts", "v"))


def test_a_replayed_batch_changes_neither_table(spark):
    s, data = source(spark), events()
    assert s.push(frame(spark, data[:100]), 0) and s.push(frame(spark, data[100:]), 1)
    before = state(s)
    assert not s.push(frame(spark, data[100:]), 1) and not s.push(frame(spark, data[:100]), 0)
    assert state(s) == before and len(before[0]) == len(data)
    assert before[1] == rows(pick_per_key(frame(spark, data), ["k"], ["ts", "id"], "last").select("id", "k", "ts", "v"))


def test_late_rows_reach_the_history_but_not_the_online_row(spark):
    s = source(spark)
    s.push(frame(spark, [(1, "a", T0 + timedelta(hours=5), 1.0)]), 0)
    s.push(frame(spark, [(2, "a", T0, 2.0), (3, "b", T0, 3.0)]), 1)
    history, online = state(s)
    assert len(history) == 3 and [r[0] for r in online] == [1, 3]
    # the history answers as of then, the online table as of now
    assert rows(s.features(spark.createDataFrame([("a",), ("c",)], "k string"))) == [("a", 1.0), ("c", None)]


def test_a_batch_that_dies_before_its_commit_is_nowhere(spark):
    s, data = source(spark), events()
    s.push(frame(spark, data[:50]), 0)
    before = state(s)
    s.log.stage("history", frame(spark, data[50:]).select("k", "ts", "id", "v"), 1)  # written, then the driver is lost
    assert state(s) == before
    s.push(frame(spark, data[50:]), 1)
    assert len(state(s)[0]) == len(data)


def test_readers_open_one_base_and_the_batches_after_it(spark):
    s, data = source(spark, compact_every=4), events()
    for i in range(10):
        s.push(frame(spark, data[i * 30 : i * 30 + 30]), i)
    paths = [e["path"] for e in s.log.entries() if e["name"] == "online"]
    assert len(paths) == 3 and sum("base" in p for p in paths) == 1
    opened = {f.rsplit("/", 2)[1] for f in s.online().inputFiles()}
    assert opened == {p.rsplit("/", 1)[1] for p in paths}
    assert state(s)[1] == rows(pick_per_key(frame(spark, data), ["k"], ["ts", "id"], "last").select("id", "k", "ts", "v"))
    assert len(state(s)[0]) == len(data) and s.log.last_batch() == 9 and not s.push(frame(spark, data[:9]), 9)


def test_a_reader_that_began_before_a_compaction_reads_on(spark):
    s, data = source(spark), events()
    for i in range(3):
        s.push(frame(spark, data[i * 50 : i * 50 + 50]), i)
    reader = s.online()
    s.compact()
    s.push(frame(spark, [(999, "a", T0 + timedelta(days=99), 5.0)]), 3)
    assert 999 not in {r["id"] for r in reader.collect()} and 999 in {r["id"] for r in s.online().collect()}


def test_an_unfinished_compaction_is_not_seen(spark):
    s, data = source(spark), events()
    s.push(frame(spark, data), 0)
    before = state(s)
    path, fs = s.log._path(f"{s.log.root}/manifest/{1:010d}/_temporary")
    fs.mkdirs(path)
    assert state(s) == before


def test_the_stream_goes_on_where_it_stopped(spark):
    data = events()
    stream, stored = feed(spark, [data[:100], data[100:200]])
    s = source(spark, compact_every=2)
    s.run(stream)
    s.run(stream)
    assert len(state(s)[0]) == 200 and s.log.last_batch() == 1
    assert state(s)[1] == rows(pick_per_key(stored, ["k"], ["ts", "id"], "last").select("id", "k", "ts", "v"))


def test_the_history_is_a_view(spark):
    from tablewright.operators.features import FeatureService, historical_features

    s = source(spark)
    s.push(frame(spark, [(1, "a", T0, 1.0), (2, "a", T0 + timedelta(hours=2), 2.0)]), 0)
    e = spark.createDataFrame([("a", T0 + timedelta(hours=h)) for h in (1, 3)], "k string, at timestamp_ntz")
    got = historical_features(e, FeatureService("s", ((s.view(), ("v",)),)), "at")
    assert [r["v"] for r in got.orderBy("at").collect()] == [1.0, 2.0]


def test_a_log_without_a_table(spark):
    log = BatchLog(spark)
    assert log.last_batch() == -1 and log.entries() == []
    with pytest.raises(LookupError):
        log.read("x")
    log.compact({"x": lambda r: r})
    assert log.write(3, {"x": spark.range(2).toDF("id")}) and not log.write(3, {"x": spark.range(5).toDF("id")})
    assert rows(log.read("x")) == [(0, 3), (1, 3)] and log.read("x", after=3).collect() == []
    assert log.read("x", after=2).where(F.col(BATCH) == 3).count() == 2 and datetime(2024, 1, 1) == T0
