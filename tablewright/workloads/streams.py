"""The continuous jobs, run over the events table as a file stream."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.features import FeatureService, historical_features
from tablewright.sources.workspace import new_dir
from tablewright.streaming.jobs import file_stream, stream_drift, stream_identity, stream_materialize
from tablewright.streaming.push import push_source
from tablewright.workloads.base import query, table


def live_events(spark, sf):
    return file_stream(spark, sf, table(spark, sf, "events").schema, "events.parquet")


@query(
    "stream_materialize",
    """
    SELECT user_id, ts, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def materialized(spark, sf):
    rows = live_events(spark, sf).select("user_id", "ts", "event_id", "event_type", "value")
    return stream_materialize(rows, ["user_id"], "ts", ["event_id"], new_dir(spark, "stream"))


@query(
    "stream_identity",
    """
    SELECT event_type, avg(round(value * 100)) AS mean_value, count(*) AS n FROM (
      SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 256)
    GROUP BY event_type
    """,
)
def identity(spark, sf):
    rows = live_events(spark, sf).selectExpr("event_id", "ts", "event_type", "rint(value * 100) AS cents")
    return stream_identity(rows, ["event_type"], "cents", "ts", "event_id", new_dir(spark, "stream"))


@query(
    "stream_drift",
    """
    WITH r AS (SELECT count(*) AS n_ref, avg(round(value * 100)) AS mean_ref, var_samp(round(value * 100)) AS var_ref
               FROM events WHERE event_type <> 'purchase'),
    w AS (SELECT date_trunc('day', ts) AS window_start, count(*) AS n_live, avg(round(value * 100)) AS mean_live,
            var_samp(round(value * 100)) AS var_live FROM events WHERE event_type = 'purchase' GROUP BY 1)
    SELECT window_start, 'cents' AS column_name, n_ref, n_live, mean_ref, mean_live,
      CASE WHEN n_live > 1 THEN round((mean_live - mean_ref) / sqrt(var_ref / n_ref + var_live / n_live), 6) END AS t
    FROM w CROSS JOIN r
    """,
)
def drift(spark, sf):
    live = live_events(spark, sf).where("event_type = 'purchase'").selectExpr("ts", "rint(value * 100) AS cents")
    reference = table(spark, sf, "events").where("event_type <> 'purchase'").selectExpr("rint(value * 100) AS cents")
    out = stream_drift(live, reference, "ts", ["cents"], "1 day", "2 days", new_dir(spark, "stream"))
    return out.select(
        "window_start", "column_name", "n_ref", "n_live", "mean_ref", "mean_live", F.round("t", 6).alias("t")
    )


def pushed(spark, sf):
    """The events pushed in four files, so in four batches, with a compaction between."""
    folder = new_dir(spark, "feed")
    # late rows: a file holds every fourth event
    part = F.pmod("event_id", F.lit(4))
    table(spark, sf, "events").repartition(4, part).write.parquet(folder)
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    source = push_source(spark, "activity", ["user_id"], "ts", "event_id", schema, compact_every=2)
    source.run(file_stream(spark, folder, spark.read.parquet(folder).schema, files_per_batch=1))
    return source


@query(
    "push_online",
    """
    SELECT user_id, ts, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def push_online(spark, sf):
    return pushed(spark, sf).online()


@query(
    "push_history",
    """
    WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    f AS (SELECT user_id, ts, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
    SELECT e.event_id, e.user_id, e.ts, f.event_type, f.value FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.ts
    """,
)
def push_history(spark, sf):
    """What was known of each user at each purchase, from the pushed history."""
    view = pushed(spark, sf).view()
    entities = table(spark, sf, "events").where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    wanted = FeatureService("history", ((view, ("event_type", "value")),))
    return historical_features(entities, wanted, "ts")
