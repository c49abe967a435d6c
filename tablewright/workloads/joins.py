"""Joins, as-of joins and set operations."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tablewright.operators.asof import asof_join, one_row_per_instant
from tablewright.operators.incremental import new_rows, upsert
from tablewright.operators.joins import anti, decode, merge
from tablewright.plans.charts import top_items
from tablewright.workloads.base import query, table

TOP_ITEMS = """
SELECT p_name, avg(round(l_extendedprice * 100)) AS popularity
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_shipdate >= TIMESTAMP '1997-12-20' AND l_shipdate < TIMESTAMP '1998-01-01'
GROUP BY p_name ORDER BY popularity DESC, p_name LIMIT 10
"""


@query("top_items_of_period", TOP_ITEMS)
def top_items_of_period(spark, sf):
    rankings = table(spark, sf, "lineitem").selectExpr(
        "l_partkey AS item", "l_shipdate", "rint(l_extendedprice * 100) AS popularity"
    )
    properties = table(spark, sf, "part").selectExpr("p_partkey AS item", "p_name")
    return top_items(
        rankings, properties, "item", "p_name", "l_shipdate", "popularity", datetime(1997, 12, 20), datetime(1998, 1, 1)
    )


@query(
    "join_inner",
    "SELECT l_orderkey, l_partkey, l_quantity, p_brand, p_size FROM lineitem JOIN part ON l_partkey = p_partkey",
)
def join_inner(spark, sf):
    facts = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    properties = table(spark, sf, "part").drop("p_name", "p_type").withColumnRenamed("p_partkey", "l_partkey")
    return facts.join(properties.select("l_partkey", "p_brand", "p_size"), "l_partkey", "inner")


@query(
    "join_left_suffix",
    """
    SELECT l.item, l.name AS name_x, l.day AS day_x, l.quantity, r.name AS name_y, r.day AS day_y, r.balance
    FROM (SELECT nullif(l_suppkey, 3) AS item, l_returnflag AS name, l_shipdate AS day, l_quantity AS quantity
          FROM lineitem) l
    LEFT JOIN (SELECT nullif(s_suppkey, 3) AS item, s_name AS name, s_nationkey AS day, s_acctbal AS balance
               FROM (SELECT * REPLACE (s_suppkey + 2 AS s_suppkey) FROM supplier)) r
      ON l.item IS NOT DISTINCT FROM r.item
    """,
)
def join_left_suffix(spark, sf):
    left = table(spark, sf, "lineitem").selectExpr(
        "nullif(l_suppkey, 3) AS item", "l_returnflag AS name", "l_shipdate AS day", "l_quantity AS quantity"
    )
    right = table(spark, sf, "supplier").selectExpr(  # keys are shifted, so that some have no partner
        "nullif(s_suppkey + 2, 3) AS item", "s_name AS name", "s_nationkey AS day", "s_acctbal AS balance"
    )
    return merge(left, right, "item", "left")


@query(
    "join_anti",
    """
    SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (
      SELECT 1 FROM lineitem WHERE l_partkey + 7 = p_partkey)
    """,
)
def join_anti(spark, sf):
    sold = table(spark, sf, "lineitem").selectExpr("l_partkey + 7 AS p_partkey")
    return anti(table(spark, sf, "part").select("p_partkey", "p_name"), sold, "p_partkey")


def entities_and_history(spark, sf):
    events = table(spark, sf, "events")
    entities = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    history = events.where("event_type IN ('view', 'click')").selectExpr(
        "user_id", "ts AS feature_ts", "event_id AS feature_id", "value AS feature"
    )
    return entities, history


ENTITIES = """
WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
f AS (SELECT user_id, ts AS feature_ts, event_id AS feature_id, value AS feature
      FROM events WHERE event_type IN ('view', 'click'))
"""


@query(
    "join_asof",
    ENTITIES
    + """
    SELECT e.event_id, e.user_id, e.ts, f.feature_ts AS matched_ts, f.feature
    FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.feature_ts
    """,
)
def join_asof(spark, sf):
    entities, history = entities_and_history(spark, sf)
    return asof_join(
        entities, history, ["user_id"], "ts", "feature_ts", ["feature"], ["feature_id"], ts_alias="matched_ts"
    )


@query(
    "join_asof_hot_keys",
    ENTITIES
    + """
    , m AS (SELECT e.event_id, e.user_id, e.ts, f.feature_ts, f.feature
            FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.feature_ts)
    SELECT event_id, user_id, ts, feature FROM m WHERE feature_ts IS NOT NULL OR user_id NOT IN (SELECT user_id FROM f)
    """,
)
def join_asof_hot_keys(spark, sf):
    """The same join with a slice size at which users are cut along time, as many as the number of slices allows."""
    entities, history = entities_and_history(spark, sf)
    return asof_join(
        entities, history, ["user_id"], "ts", "feature_ts", ["feature"], ["feature_id"], unmatched="drop_expired",
        rows_per_slice=25,
    )


@query(
    "join_asof_ttl",
    ENTITIES
    + """
    , m AS (SELECT e.event_id, e.user_id, e.ts, f.feature_ts, f.feature
            FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.feature_ts)
    SELECT event_id, user_id, ts, feature FROM m
    WHERE feature_ts >= ts - INTERVAL 36 HOUR OR user_id NOT IN (SELECT user_id FROM f)
    """,
)
def join_asof_ttl(spark, sf):
    entities, history = entities_and_history(spark, sf)
    return asof_join(
        entities, history, ["user_id"], "ts", "feature_ts", ["feature"], ["feature_id"],
        ttl=timedelta(hours=36), unmatched="drop_expired",
    )


@query(
    "collapse_instants",
    """
    SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1
    """,
)
def collapse_instants(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return one_row_per_instant(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query(
    "decode_label",
    "SELECT c_custkey, c_nationkey, n_name AS country FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def decode_label(spark, sf):
    codes = table(spark, sf, "nation").selectExpr("n_nationkey AS code", "n_name AS label")
    return decode(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), codes, "c_nationkey", "country")


@query(
    "pair_features_labels",
    "SELECT d.doc_id, n_chars, lang, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def pair_features_labels(spark, sf):
    features = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    return features.join(table(spark, sf, "labels"), "doc_id", "inner")


@query(
    "union_by_name",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey, o_custkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    """,
)
def union_by_name(spark, sf):
    orders = table(spark, sf, "orders")
    opened = orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey", "o_totalprice")
    closed = orders.where("o_orderstatus = 'F'").select("o_orderpriority", "o_custkey", "o_orderkey")
    return opened.unionByName(closed, allowMissingColumns=True)


@query("self_concat", "SELECT p_partkey, p_name FROM part UNION ALL SELECT p_partkey, p_name FROM part")
def self_concat(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return parts.union(parts)


# Old orders up to a day, and a later delivery that repeats some with another price.
OLD = "o_orderdate < TIMESTAMP_NTZ '2000-01-01'"
NEW = "o_orderdate >= TIMESTAMP_NTZ '1998-01-01'"


def old_and_new(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return orders.where(OLD), orders.where(NEW).withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query(
    "upsert",
    """
    SELECT o_orderkey, o_custkey, o_orderdate,
      CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def upsert_orders(spark, sf):
    old, new = old_and_new(spark, sf)
    return upsert(old, new, ["o_orderkey"])


@query(
    "upsert_unshuffled",
    """
    SELECT o_orderkey, o_custkey, o_orderdate,
      CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def upsert_unshuffled(spark, sf):
    old, new = old_and_new(spark, sf)
    return upsert(old, new, ["o_orderkey"], ["o_orderdate"], old_is_unique=True)


@query(
    "diff_new_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, o_orderdate FROM orders "
    "WHERE o_orderdate >= TIMESTAMP '2000-01-01'",
)
def diff_new_rows(spark, sf):
    old, new = old_and_new(spark, sf)
    return new_rows(old, new, ["o_orderkey"])
