"""Sources, sinks and payloads."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.payload import request, response, response_data
from tablewright.operators.ordering import sorted_codes
from tablewright.operators.prep import MinMax, encode_labels, split
from tablewright.operators.versions import VersionedTable
from tablewright.sources.snapshot import read_snapshot, write_snapshot
from tablewright.sources.tables import list_objects, read_csv, read_parquet, write_csv, write_parquet
from tablewright.sources.workspace import new_dir
from tablewright.workloads.base import query, table


@query("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(spark, sf):
    return read_parquet(spark, f"{sf}/lineitem.parquet")


ORDERS_CSV = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@query("scan_csv", "SELECT * FROM orders")
def scan_csv(spark, sf):
    path = new_dir(spark, "csv")
    write_csv(table(spark, sf, "orders"), path)
    return read_csv(spark, path, ORDERS_CSV, multi_line=False)  # no field holds a line break


@query("sink_csv", "SELECT doc_id, lang, source, n_chars, text FROM documents")
def sink_csv(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    path = new_dir(spark, "csv")
    write_csv(docs, path)
    return read_csv(spark, path, docs.schema)


@query(
    "sink_csv_times",
    """
    SELECT event_id, ts + to_microseconds(event_id % 1000 * 2) AS ts, '  ' || event_type || ' ' AS event_type
    FROM events
    """,
)
def sink_csv_times(spark, sf):
    """Times that differ by microseconds, and blanks around texts, come back as they were."""
    rows = table(spark, sf, "events").select(
        "event_id",
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 1000 * 2)
        .cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("event_type"),
    )
    path = new_dir(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema, multi_line=False)


@query("sink_parquet", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus FROM orders")
def sink_parquet(spark, sf):
    path = new_dir(spark, "parquet")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus"
    )
    write_parquet(rows, path, partition_by=["o_orderstatus"])
    return read_parquet(spark, path)


@query(
    "sink_replace",
    "SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus <> 'P'",
)
def sink_replace(spark, sf):
    stored = VersionedTable(spark).create(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    )
    # the new state is computed from the one it replaces
    current = stored.read().where("o_orderstatus <> 'P'")
    stored.write(current.selectExpr("o_orderkey", "o_custkey", "o_totalprice + 1 AS o_totalprice"))
    return stored.read()


@query(
    "rewrite_in_place",
    "SELECT p_partkey, p_name AS item_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def rewrite_in_place(spark, sf):
    stored = VersionedTable(spark).create(table(spark, sf, "part"))
    stored.rename_column("p_name", "item_name")
    return stored.read()


SPLIT_ORDERS = """
WITH ranked AS (
  SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders
), rest AS (
  SELECT *, row_number() OVER (
      PARTITION BY o_orderpriority ORDER BY md5(concat_ws('/', CAST(o_orderkey AS VARCHAR), '42')), o_orderkey) AS vr,
    count(*) OVER (PARTITION BY o_orderpriority) AS vn
  FROM ranked WHERE rn <= n - (n * 20 + 99) // 100
), parted AS (
  SELECT o_orderkey, o_orderpriority, o_totalprice,
    CASE WHEN vr <= (vn * 20 + 50) // 100 THEN 'val' ELSE 'train' END AS split FROM rest
  UNION ALL
  SELECT o_orderkey, o_orderpriority, o_totalprice, 'test' FROM ranked WHERE rn > n - (n * 20 + 99) // 100
)
"""


@query("sink_splits", SPLIT_ORDERS + "SELECT o_orderkey, o_orderpriority, split FROM parted")
def sink_splits(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    parts = split(orders, ["o_orderkey"], "o_orderpriority", "o_orderkey")
    path = new_dir(spark, "splits")
    write_parquet(parts, path, partition_by=["split"])
    return read_parquet(spark, path)


def stored_training(spark, sf):
    """Splits, scaler and class codes written side by side; returns their folder."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = new_dir(spark, "training")
    write_parquet(split(orders, ["o_orderkey"], "o_orderpriority", "o_orderkey"), f"{path}/splits")
    train = read_parquet(spark, f"{path}/splits").where("split = 'train'")
    write_parquet(MinMax.fit(train, ["o_totalprice"]).table(spark), f"{path}/scaler")
    write_parquet(sorted_codes(train, "o_orderpriority"), f"{path}/codes")
    return path


@query(
    "sink_fitted",
    SPLIT_ORDERS
    + """SELECT 'o_totalprice' AS name, min(o_totalprice) AS low, max(o_totalprice) AS high FROM parted WHERE split = 'train'
    UNION ALL SELECT o_orderpriority, rank() OVER (ORDER BY o_orderpriority) - 1, NULL FROM parted
    WHERE split = 'train' GROUP BY o_orderpriority""",
)
def sink_fitted(spark, sf):
    """The stored parameters: the scaler's bounds, and the number of every class."""
    path = stored_training(spark, sf)
    scaler = read_parquet(spark, f"{path}/scaler").selectExpr("feature AS name", "min AS low", "max AS high")
    codes = read_parquet(spark, f"{path}/codes").selectExpr("label AS name", "CAST(code AS DOUBLE) AS low", "CAST(NULL AS DOUBLE) AS high")
    return scaler.unionByName(codes)


@query(
    "load_and_scale",
    SPLIT_ORDERS
    + """, t AS (SELECT min(o_totalprice) AS low, max(o_totalprice) AS high FROM parted WHERE split = 'train'),
    c AS (SELECT o_orderpriority, rank() OVER (ORDER BY o_orderpriority) - 1 AS code FROM parted
      WHERE split = 'train' GROUP BY o_orderpriority)
    SELECT o_orderkey, round((o_totalprice - low) / (high - low), 9) AS scaled, code
    FROM orders LEFT JOIN c USING (o_orderpriority), t""",
)
def load_and_scale(spark, sf):
    """A serving job that knows only what was stored."""
    path = stored_training(spark, sf)
    scaler = MinMax.load(read_parquet(spark, f"{path}/scaler"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    coded = encode_labels(scaler.transform(orders), "o_orderpriority", read_parquet(spark, f"{path}/codes"))
    return coded.select("o_orderkey", F.round("o_totalprice", 9).alias("scaled"), "code")


@query(
    "online_sink",
    """
    SELECT user_id, ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def online_sink(spark, sf):
    from tablewright.operators.ordering import latest_per_key

    newest = latest_per_key(table(spark, sf, "events"), ["user_id"], "ts", ["event_id"])
    path = new_dir(spark, "online")
    write_snapshot(newest.select("user_id", "ts", "event_type", "value"), path)
    return read_snapshot(spark, path)


@query(
    "payload_json",
    """
    SELECT l_orderkey, l_partkey, l_suppkey,
      '{"inputs":[' || string_agg('{"name":"' || name || '","shape":[1,1],"datatype":"FP32","data":['
        || CAST(value AS VARCHAR) || ']}', ',' ORDER BY pos) || ']}' AS payload
    FROM (
      SELECT rid, l_orderkey, l_partkey, l_suppkey, f.name, f.pos, f.value
      FROM (SELECT row_number() OVER () AS rid, * FROM lineitem),
      UNNEST([
        {'name': 'l_quantity', 'pos': 1, 'value': l_quantity},
        {'name': 'l_extendedprice', 'pos': 2, 'value': l_extendedprice},
        {'name': 'l_discount', 'pos': 3, 'value': l_discount},
        {'name': 'l_tax', 'pos': 4, 'value': l_tax}]) AS u(f)
    ) GROUP BY rid, l_orderkey, l_partkey, l_suppkey
    """,
)
def payload_json(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", request(columns).alias("payload")
    )


@query(
    "payload_parse",
    """
    SELECT vec_id, CAST(i - 1 AS INTEGER) AS position, CAST(embedding[i] AS DOUBLE) AS value
    FROM embeddings, UNNEST(range(1, len(embedding) + 1)) AS r(i)
    """,
)
def payload_parse(spark, sf):
    answers = table(spark, sf, "embeddings").select("vec_id", response(F.col("embedding")).alias("body"))
    parsed = answers.select("vec_id", response_data(F.col("body")).alias("data"))
    return parsed.select("vec_id", F.posexplode("data").alias("position", "value"))


@query(
    "parse_properties",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def parse_properties(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.from_json("props", "struct<k:bigint>")["k"].alias("k")
    )


@query("list_objects", "SELECT event_type, 1 AS files, true AS filled, true AS recent FROM events GROUP BY event_type")
def listed(spark, sf):
    """The files a partitioned write left, one folder a type, from the listing alone."""
    path = new_dir(spark, "artifacts")
    write_parquet(table(spark, sf, "events").repartition("event_type"), path, ["event_type"])
    found = list_objects(spark, path, "*.parquet")
    folder = F.element_at(F.split("path", "/"), -2)
    return found.groupBy(F.regexp_extract(folder, "event_type=(.*)", 1).alias("event_type")).agg(
        F.count(F.lit(1)).cast("int").alias("files"), F.min(F.col("length") > 0).alias("filled"),
        F.min(F.col("modificationTime") > F.lit("2024-01-01").cast("timestamp")).alias("recent"),
    )
