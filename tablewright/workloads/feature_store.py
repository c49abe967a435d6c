"""Feature views, point-in-time training sets and the serving table."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.features import (
    FeatureService,
    FeatureView,
    OnlineTable,
    historical_features,
    service_from_refs,
)
from tablewright.operators.versions import VersionedTable
from tablewright.plans import etl
from tablewright.workloads.base import query, table

START, MIDDLE, END = datetime(2024, 1, 1), datetime(2024, 1, 15), datetime(2024, 1, 25)


def view_of(spark, sf, kind: str, feature: str) -> FeatureView:
    """The events of one kind as a view keyed by user."""
    rows = table(spark, sf, "events").where(F.col("event_type") == kind).select(
        "user_id", "ts", "event_id", F.col("value").alias(feature)
    )
    schema = T.StructType([T.StructField(feature, T.DoubleType())])
    return FeatureView(f"{kind}s", ("user_id",), "ts", schema, rows, created="event_id")


def all_events(spark, sf) -> FeatureView:
    schema = T.StructType(
        [T.StructField("event_type", T.StringType()), T.StructField("value", T.FloatType())]
    )
    return FeatureView("activity", ("user_id",), "ts", schema, table(spark, sf, "events"), created="event_id")


def purchases(spark, sf):
    return table(spark, sf, "events").where("event_type = 'purchase'").select("event_id", "user_id", "ts")


@query("feature_view", "SELECT user_id, ts, event_id, event_type, CAST(value AS FLOAT) AS value FROM events")
def feature_view(spark, sf):
    return all_events(spark, sf).table()


@query("feature_service", "SELECT user_id, ts, event_id, CAST(value AS FLOAT) AS value FROM events")
def feature_service(spark, sf):
    service = FeatureService("serving", ((all_events(spark, sf), ("value",)),))
    view, names = service.projections[0]
    return view.table(names)


MULTI = """
WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
a AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view'),
b AS (SELECT user_id, ts, value FROM events WHERE event_type = 'click'),
j AS (SELECT e.*, a.value AS viewed FROM e ASOF LEFT JOIN a ON e.user_id = a.user_id AND e.ts >= a.ts)
SELECT j.event_id, j.user_id, j.ts, j.viewed, b.value AS clicked
FROM j ASOF LEFT JOIN b ON j.user_id = b.user_id AND j.ts >= b.ts
"""


@query("join_multi_view", MULTI)
def join_multi_view(spark, sf):
    views = [view_of(spark, sf, "view", "viewed"), view_of(spark, sf, "click", "clicked")]
    service = service_from_refs(["views:viewed", "clicks:clicked"], views)
    return historical_features(purchases(spark, sf), service, "ts")


@query(
    "historical_features",
    """
    WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    a AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view'),
    j AS (SELECT e.*, a.ts AS seen_ts, a.value AS viewed FROM e ASOF LEFT JOIN a ON e.user_id = a.user_id AND e.ts >= a.ts)
    SELECT event_id, user_id, ts, viewed FROM j WHERE seen_ts IS NOT NULL OR user_id NOT IN (SELECT user_id FROM a)
    """,
)
def historical(spark, sf):
    service = service_from_refs(["views:viewed"], [view_of(spark, sf, "view", "viewed")])
    return historical_features(purchases(spark, sf), service, "ts", unmatched="drop_expired")


LATEST = """
SELECT user_id, ts, event_id, event_type, CAST(value AS FLOAT) AS value FROM events
WHERE ts >= TIMESTAMP '2024-01-01' AND ts <= TIMESTAMP '{}'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


@query("materialize", LATEST.format("2024-01-15"))
def materialize(spark, sf):
    return OnlineTable(spark, all_events(spark, sf)).materialize(START, MIDDLE)


@query("materialize_incremental", LATEST.format("2024-01-25"))
def materialize_incremental(spark, sf):
    online = OnlineTable(spark, all_events(spark, sf))
    online.materialize(START, MIDDLE)
    return online.materialize_incremental(END)


@query("materialize_again", LATEST.format("2024-01-15"))
def materialize_again(spark, sf):
    """Filled anew after an incremental step: the table is what the new call says."""
    online = OnlineTable(spark, all_events(spark, sf))
    online.materialize(START, MIDDLE)
    online.materialize_incremental(END)
    return online.materialize(START, MIDDLE)


@query("etl_load", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def etl_load(spark, sf):
    source = table(spark, sf, "orders").selectExpr("o_orderkey AS O_OrderKey", "o_custkey AS O_CUSTKEY", "o_totalprice")
    return etl.load(source, VersionedTable(spark))


@query("etl_load_again", "SELECT o_orderkey, o_custkey, o_totalprice + 3 AS o_totalprice FROM orders")
def etl_load_again(spark, sf):
    """The newest of four loads is the current one."""
    target = VersionedTable(spark)
    for i in range(4):
        source = table(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey", f"o_totalprice + {i} AS o_totalprice")
        loaded = etl.load(source, target)
    return loaded


@query(
    "etl_upsert",
    """
    SELECT o_orderkey, o_custkey,
      CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
      CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN TIMESTAMP '2024-02-01'
        ELSE TIMESTAMP '2024-01-01' END AS event_timestamp
    FROM orders
    """,
)
def etl_upsert(spark, sf):
    """Load, refresh, materialise; returns the serving table after the refresh."""
    from tablewright.operators.columns import add_ingest_time

    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    old = orders.where("o_orderdate < TIMESTAMP_NTZ '2000-01-01'").drop("o_orderdate")
    new = (
        orders.where("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'")
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
        .drop("o_orderdate")
    )
    stored = VersionedTable(spark)
    first, second = datetime(2024, 1, 1), datetime(2024, 2, 1)
    etl.load(add_ingest_time(old, first), stored)
    schema = T.StructType(
        [T.StructField("o_custkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())]
    )
    view = FeatureView("orders", ("o_orderkey",), "event_timestamp", schema, stored.read())
    online = OnlineTable(spark, view)
    online.materialize(first, first)
    etl.refresh(stored, new, ["o_orderkey"], second, online)
    return online.read()
