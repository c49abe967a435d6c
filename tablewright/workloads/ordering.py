"""Per-key picks, numbering, moving frames, sorting and top-k."""

from pyspark.sql import functions as F

from tablewright.operators import ordering as o
from tablewright.operators.slicing import row_number
from tablewright.workloads.base import query, table

PICK = "SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER " \
    "(PARTITION BY l_partkey ORDER BY {}) = 1"


@query("dedup_keep_first", PICK.format("l_shipdate, l_orderkey, l_linenumber"))
def dedup_keep_first(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber")
    return o.pick_per_key(rows, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], "first")


@query("dedup_keep_last", PICK.format("l_shipdate DESC, l_orderkey DESC, l_linenumber DESC"))
def dedup_keep_last(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber")
    return o.pick_per_key(rows, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], "last")


@query(
    "latest_per_key",
    """
    SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def latest(spark, sf):
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-20"))
    return o.latest_per_key(table(spark, sf, "events"), ["user_id"], "ts", ["event_id"], start, end)


@query(
    "latest_artifact",
    """
    SELECT event_type || '/model.bin' AS short_name, 'runs/' || user_id || '/' || event_type || '/' || event_id
      || '/model.bin' AS key, ts AS modified FROM events WHERE ts <= TIMESTAMP '2024-01-20'
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, key DESC) = 1
    """,
)
def artifact(spark, sf):
    objects = table(spark, sf, "events").select(
        F.concat_ws("/", F.lit("runs"), "user_id", "event_type", "event_id", F.lit("model.bin")).alias("key"),
        F.col("ts").alias("modified"),
    )
    return o.latest_artifact(objects, F.lit("2024-01-20").cast("timestamp_ntz"))


@query(
    "ordinal_first_seen",
    """
    SELECT event_type AS label, row_number() OVER (ORDER BY first_ts) - 1 AS code
    FROM (SELECT event_type, min(ts) AS first_ts FROM events GROUP BY event_type)
    """,
)
def ordinal_first_seen(spark, sf):
    return o.first_seen_codes(table(spark, sf, "events"), "event_type", ["ts", "event_id"])


@query(
    "label_encode",
    "SELECT p_name AS label, row_number() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part)",
)
def label_encode(spark, sf):
    return o.sorted_codes(table(spark, sf, "part"), "p_name")


@query(
    "row_position",
    """
    SELECT o_orderkey, o_orderdate + to_microseconds(2 * (row_number() OVER (ORDER BY o_orderkey) - 1)) AS o_orderdate
    FROM orders
    """,
)
def row_position(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return o.shift_by_position(rows, "o_orderdate", ["o_orderkey"])


@query(
    "ts_unique_shift",
    """
    SELECT o_orderkey, o_custkey, o_orderdate + to_microseconds(
      2 * (row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) - 1)) AS o_orderdate
    FROM orders
    """,
)
def ts_unique_shift(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return o.unique_times(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"])


def cents(spark, sf):
    return table(spark, sf, "events").selectExpr("event_id", "ts", "event_type", "rint(value * 100) AS cents")


@query(
    "identity_metric",
    """
    SELECT event_type, avg(round(value * 100)) AS mean_value, count(*) AS n FROM (
      SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 256)
    GROUP BY event_type
    """,
)
def identity_metric(spark, sf):
    return o.identity_now(cents(spark, sf), ["event_type"], "cents", "ts", "event_id")


@query(
    "identity_history",
    """
    SELECT event_type, ts, event_id, avg(round(value * 100)) OVER (
      PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 255 PRECEDING AND CURRENT ROW) AS mean_value
    FROM events
    """,
)
def identity_history(spark, sf):
    return o.identity_history(cents(spark, sf), ["event_type"], "cents", "ts", "event_id")


@query(
    "identity_history_sliced",
    """
    SELECT event_type, ts, event_id, avg(round(value * 100)) OVER (
      PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 255 PRECEDING AND CURRENT ROW) AS mean_value
    FROM events
    """,
)
def identity_history_sliced(spark, sf):
    """The same with every event type cut into many partitions, on small tables shorter than a frame."""
    return o.identity_history(cents(spark, sf), ["event_type"], "cents", "ts", "event_id", rows_per_slice=100)


@query("sort_by", "SELECT event_id, ts, value FROM events ORDER BY value DESC, event_id")
def sort_by(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "value").orderBy(F.desc("value"), "event_id")


@query(
    "top_k",
    """
    SELECT p_name, avg(round(l_extendedprice * 100)) AS popularity FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_name ORDER BY popularity DESC, p_name LIMIT 10
    """,
)
def top_k(spark, sf):
    from tablewright.workloads.aggregates import group_mean

    return group_mean(spark, sf).orderBy(F.desc("popularity"), "p_name").limit(10)


@query("head_n", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5000")
def head_n(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(5000)


@query(
    "label_encode_decimal",
    """
    SELECT CAST(l_tax AS DECIMAL(10, 2)) AS label, dense_rank() OVER (ORDER BY CAST(l_tax AS DECIMAL(10, 2))) - 1 AS code
    FROM lineitem GROUP BY 1
    """,
)
def label_encode_decimal(spark, sf):
    return o.sorted_codes(table(spark, sf, "lineitem").selectExpr("CAST(l_tax AS DECIMAL(10, 2)) AS tax"), "tax")


@query(
    "row_position_by_url",
    """
    SELECT page_id, row_number() OVER (ORDER BY 'https://a-long-prefix-that-all-rows-share.example/' || url, page_id) AS at
    FROM pages
    """,
)
def row_position_by_url(spark, sf):
    """Texts that differ only behind a long common beginning."""
    rows = table(spark, sf, "pages").selectExpr(
        "page_id", "concat('https://a-long-prefix-that-all-rows-share.example/', url) AS url"
    )
    return row_number(rows, [], ["url", "page_id"], "at").select("page_id", "at")
