"""On-demand features, and the indexed serving table."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.features import FeatureService
from tablewright.operators.ondemand import Derived, OnDemandView, historical, online, plan
from tablewright.operators.online_index import IndexedOnlineTable, IndexedTable, RangedTable
from tablewright.operators.ordering import latest_per_key
from tablewright.workloads.base import query, table
from tablewright.workloads.feature_store import END, LATEST, MIDDLE, START, all_events, view_of

# Rows of a bucket in these queries, so that the small tables have many.
BUCKET_ROWS = 500


def spending() -> list[OnDemandView]:
    """How a purchase compares with what its user looked at; features of one view feed those of the next."""
    zero = F.lit(0.0)
    activity = OnDemandView(
        "activity",
        (
            Derived("seen", T.DoubleType(), ("views:value", "clicks:value"), lambda v, c: F.coalesce(v, zero) + F.coalesce(c, zero)),
            Derived("clicked_share", T.DoubleType(), ("clicks:value", "activity:seen"), lambda c, s: F.when(s > 0, F.coalesce(c, zero) / s)),
        ),
    )
    offer = OnDemandView(
        "offer",
        (
            Derived("ratio", T.DoubleType(), ("request:amount", "activity:seen"), lambda a, s: a / (s + 1)),
            Derived("high", T.BooleanType(), ("offer:ratio", "activity:clicked_share"), lambda r, c: (r > 1) & (F.coalesce(c, zero) < 0.5)),
        ),
    )
    return [activity, offer]


REFS = ["offer:high", "activity:clicked_share", "offer:ratio"]
REQUEST = T.StructType([T.StructField("amount", T.DoubleType())])

DERIVED = """
SELECT {keys}, ratio > 1 AND coalesce(clicked_share, 0) < 0.5 AS high, round(clicked_share, 9) AS clicked_share, round(ratio, 9) AS ratio
FROM (SELECT *, CASE WHEN seen > 0 THEN coalesce(clicked, 0) / seen END AS clicked_share, amount / (seen + 1) AS ratio
  FROM (SELECT *, coalesce(viewed, 0) + coalesce(clicked, 0) AS seen FROM j))
"""


def spending_plan(spark, sf):
    views = [view_of(spark, sf, "view", "value"), view_of(spark, sf, "click", "value")]
    return plan(REFS, views, spending(), REQUEST)


def rounded(df):
    return df.withColumns({c: F.round(c, 9) for c in ("clicked_share", "ratio")})


@query(
    "on_demand_view",
    """
    WITH e AS (SELECT event_id, user_id, ts, value AS amount FROM events WHERE event_type = 'purchase'),
    a AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view'),
    b AS (SELECT user_id, ts, value FROM events WHERE event_type = 'click'),
    i AS (SELECT e.*, a.value AS viewed FROM e ASOF LEFT JOIN a ON e.user_id = a.user_id AND e.ts >= a.ts),
    j AS (SELECT i.*, b.value AS clicked FROM i ASOF LEFT JOIN b ON i.user_id = b.user_id AND i.ts >= b.ts)
    """
    + DERIVED.format(keys="event_id, user_id, ts, amount"),
)
def on_demand_view(spark, sf):
    """Derived features at the time of each purchase; its value is what the request brings along."""
    events = table(spark, sf, "events").where("event_type = 'purchase'")
    entities = events.select("event_id", "user_id", "ts", F.col("value").alias("amount"))
    return rounded(historical(entities, spending_plan(spark, sf), "ts"))


NEWEST = """
SELECT user_id, value FROM events WHERE event_type = '{}' AND ts >= TIMESTAMP '2024-01-01' AND ts <= TIMESTAMP '2024-01-25'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


@query(
    "on_demand_online",
    f"""
    WITH j AS (SELECT c_custkey AS user_id, CAST(c_acctbal AS DOUBLE) AS amount, a.value AS viewed, b.value AS clicked
      FROM customer LEFT JOIN ({NEWEST.format('view')}) a ON a.user_id = c_custkey
      LEFT JOIN ({NEWEST.format('click')}) b ON b.user_id = c_custkey)
    """
    + DERIVED.format(keys="user_id, amount"),
)
def on_demand_online(spark, sf):
    """The same features for a table of requests, over the serving tables."""
    wanted, tables = spending_plan(spark, sf), {}
    for view, _ in wanted.stored:
        tables[view.name] = IndexedOnlineTable(spark, view, rows_per_bucket=BUCKET_ROWS)
        tables[view.name].materialize(START, END)
    request = table(spark, sf, "customer").selectExpr("c_custkey AS user_id", "CAST(c_acctbal AS DOUBLE) AS amount")
    return rounded(online(request, wanted, tables))


@query(
    "lookup_online",
    """
    WITH s AS (SELECT user_id, value, event_type FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT c_custkey AS user_id, event_type, value FROM customer LEFT JOIN s ON c_custkey = user_id
    """,
)
def lookup_online(spark, sf):
    snapshot = latest_per_key(table(spark, sf, "events"), ["user_id"], "ts", ["event_id"])
    stored = IndexedTable(spark, ["user_id"], rows_per_bucket=BUCKET_ROWS)
    stored.write(snapshot.select("user_id", "event_type", "value"))
    return stored.lookup(table(spark, sf, "customer").selectExpr("c_custkey AS user_id"), ["event_type", "value"])


@query(
    "online_features",
    f"SELECT c_custkey AS user_id, value, event_type FROM customer LEFT JOIN ({LATEST.format('2024-01-15')}) "
    "ON c_custkey = user_id",
)
def online_features(spark, sf):
    view = all_events(spark, sf)
    stored = IndexedOnlineTable(spark, view, rows_per_bucket=BUCKET_ROWS)
    stored.materialize(START, MIDDLE)
    service = FeatureService("serving", ((view, ("value", "event_type")),))
    return stored.features(table(spark, sf, "customer").selectExpr("c_custkey AS user_id"), service)


@query("online_index_refresh", LATEST.format("2024-01-25"))
def online_index_refresh(spark, sf):
    """Filled, then brought forward; buckets without a new row keep their files."""
    stored = IndexedOnlineTable(spark, all_events(spark, sf), rows_per_bucket=BUCKET_ROWS)
    stored.materialize(START, MIDDLE)
    return stored.materialize_incremental(END)


@query(
    "online_index_diff",
    f"""
    WITH o AS ({LATEST.format('2024-01-24')}), n AS ({LATEST.format('2024-01-25')})
    SELECT n.user_id, CASE WHEN o.user_id IS NULL THEN 'added' ELSE 'changed' END AS change
    FROM n LEFT JOIN o USING (user_id) WHERE o.user_id IS NULL OR o.event_id <> n.event_id
    """,
)
def online_index_diff(spark, sf):
    """What a refresh changed, from the buckets whose contents differ."""
    online_table = IndexedOnlineTable(spark, all_events(spark, sf), rows_per_bucket=BUCKET_ROWS)
    online_table.materialize(START, datetime(2024, 1, 24))
    online_table.materialize_incremental(END)
    return online_table.store.changes(1, 2)


def range_versions(spark, sf):
    """Orders in ranges of their keys, and a second version that changes some neighbours and adds a few below all."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    stored = RangedTable(spark, ["o_orderkey"], rows_per_bucket=BUCKET_ROWS)
    stored.write(orders)
    changed = orders.where("o_orderkey BETWEEN 100 AND 250").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    added = orders.where("o_orderkey <= 3").withColumn("o_orderkey", F.col("o_orderkey") - 1_000_000)
    stored.upsert(changed.unionByName(added))
    return stored


@query(
    "range_version_diff",
    """
    SELECT o_orderkey, 'changed' AS change FROM orders WHERE o_orderkey BETWEEN 100 AND 250
    UNION ALL SELECT o_orderkey - 1000000, 'added' FROM orders WHERE o_orderkey <= 3
    """,
)
def range_version_diff(spark, sf):
    """What changed between two versions, from the ranges whose contents differ."""
    return range_versions(spark, sf).changes(1, 2)


@query(
    "range_version_read",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey BETWEEN 100 AND 250 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders UNION ALL SELECT o_orderkey - 1000000, o_custkey, o_totalprice FROM orders WHERE o_orderkey <= 3
    """,
)
def range_version_read(spark, sf):
    """The second version: new files for the ranges that changed, the first version's for the others."""
    return range_versions(spark, sf).read()
