"""Projections, filters, predicates and scalar functions."""

from datetime import datetime

from pyspark.sql import functions as F

from tablewright.functions.scalars import argmax, metadata_map, path_part, probabilities_to_rows, version_stamp
from tablewright.operators.columns import (
    Rule,
    add_ingest_time,
    in_time_range,
    lowercase_columns,
    numeric,
    parse_date,
    replace_values,
    to_utc,
    unpivot,
    validate,
)
from tablewright.operators.prep import MinMax
from tablewright.workloads.base import query, table

# A column with gaps, made the same way on both sides.
GAPS = "nullif(l_linenumber, 1)"


@query("project", "SELECT l_orderkey, l_quantity, l_discount FROM lineitem")
def project(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount")


@query("drop_columns", "SELECT * EXCLUDE (l_returnflag, l_linestatus, l_shipdate) FROM lineitem")
def drop_columns(spark, sf):
    return table(spark, sf, "lineitem").drop("l_returnflag", "l_linestatus", "l_shipdate")


@query("rename", "SELECT * RENAME (o_orderdate AS event_timestamp) FROM orders")
def rename(spark, sf):
    return table(spark, sf, "orders").withColumnRenamed("o_orderdate", "event_timestamp")


@query("lowercase_columns", "SELECT p_partkey, p_name, p_size FROM part")
def lower_names(spark, sf):
    upper = table(spark, sf, "part").selectExpr("p_partkey AS P_PartKey", "p_name AS P_NAME", "p_size")
    return lowercase_columns(upper)


@query(
    "add_ingest_time",
    "SELECT p_partkey, p_name, TIMESTAMP '2024-05-06 07:08:09.000010' AS event_timestamp FROM part",
)
def ingest_time(spark, sf):
    return add_ingest_time(
        table(spark, sf, "part").select("p_partkey", "p_name"), datetime(2024, 5, 6, 7, 8, 9, 10)
    )


@query(
    "parse_date",
    "SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS TIMESTAMP) AS day FROM orders",
)
def parse_dates(spark, sf):
    text = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("text"))
    return text.select("o_orderkey", parse_date("text").alias("day"))


@query("to_utc", "SELECT event_id, epoch_us(ts) AS utc_micros FROM events")
def utc(spark, sf):
    return table(spark, sf, "events").select("event_id", F.unix_micros(to_utc("ts")).alias("utc_micros"))


@query(
    "cast_numeric",
    """
    SELECT l_orderkey, l_partkey, CAST(l_returnflag = 'R' AS DOUBLE) AS returned,
      CAST(l_linenumber AS DOUBLE) AS l_linenumber, CAST(l_extendedprice AS FLOAT) AS price32 FROM lineitem
    """,
)
def cast_numeric(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_returnflag = 'R' AS returned", "l_linenumber", "l_extendedprice AS price32"
    )
    return numeric(numeric(rows, ["returned", "l_linenumber"]), ["price32"], "float")


@query("filter_eq", "SELECT p_partkey, p_name, p_size FROM part WHERE p_name = 'small ring'")
def filter_eq(spark, sf):
    return table(spark, sf, "part").where(F.col("p_name") == "small ring").select("p_partkey", "p_name", "p_size")


@query(
    "filter_time_range",
    """
    SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-12-20' AND l_shipdate < TIMESTAMP '1998-01-01'
    """,
)
def filter_time_range(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    return in_time_range(rows, "l_shipdate", datetime(1997, 12, 20), datetime(1998, 1, 1))


@query(
    "dropna",
    "SELECT l_orderkey, l_partkey, nullif(l_linenumber, 1) AS line, nullif(l_returnflag, 'N') AS flag FROM lineitem "
    "WHERE l_linenumber <> 1 AND l_returnflag <> 'N'",
)
def dropna(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", f"{GAPS} AS line", "nullif(l_returnflag, 'N') AS flag"
    )
    return rows.dropna("any")


@query(
    "filter_nonzero",
    "SELECT l_orderkey, l_partkey, l_discount - l_tax AS difference FROM lineitem WHERE l_discount - l_tax <> 0.0",
)
def filter_nonzero(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", (F.col("l_discount") - F.col("l_tax")).alias("difference")
    )
    return rows.where(F.col("difference") != 0.0)


@query("threshold_flag", "SELECT event_id, value >= 30.0 AS popular FROM events")
def threshold_flag(spark, sf):
    return table(spark, sf, "events").select("event_id", (F.col("value") >= F.lit(30.0)).alias("popular"))


@query(
    "replace_values",
    """
    SELECT event_id, CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'chosen'
      WHEN 'purchase' THEN 'bought' ELSE event_type END AS event_type FROM events
    """,
)
def replace(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type")
    return replace_values(rows, "event_type", {"view": "seen", "click": "chosen", "purchase": "bought"})


@query(
    "replace_values_number",
    """
    SELECT n_nationkey, CASE n_name WHEN 'FRANCE' THEN 1 WHEN 'GERMANY' THEN 2 WHEN 'CHINA' THEN 3 END AS n_name
    FROM nation
    """,
)
def replace_number(spark, sf):
    """Text to whole numbers where most values have none."""
    rows = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return replace_values(rows, "n_name", {"FRANCE": 1, "GERMANY": 2, "CHINA": 3}, to="int", unmapped="null")


@query(
    "first_row",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 1",
)
def first_row(spark, sf):
    rows = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(1)


@query(
    "unpivot_row",
    """
    SELECT p_partkey, name, value FROM (
      SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part
    ) UNPIVOT (value FOR name IN (p_size, p_retailprice))
    """,
)
def unpivot_row(spark, sf):
    return unpivot(table(spark, sf, "part"), ["p_partkey"], ["p_size", "p_retailprice"])


@query(
    "validate_data",
    """
    SELECT 'line' AS column_name, 'not_null' AS rule, count(*) FILTER (l_linenumber = 1) AS violations FROM lineitem
    UNION ALL SELECT 'l_discount', 'high', count(*) FILTER (l_discount > 0.05) FROM lineitem
    UNION ALL SELECT 'l_quantity', 'low', count(*) FILTER (l_quantity < 2) FROM lineitem
    UNION ALL SELECT 'l_orderkey', 'unique', CAST(count(*) - count(DISTINCT l_orderkey) AS BIGINT) FROM lineitem
    """,
)
def validate_data(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey", f"{GAPS} AS line", "l_discount", "l_quantity")
    return validate(
        rows,
        [
            Rule("line", not_null=True),
            Rule("l_discount", high=0.05),
            Rule("l_quantity", low=2),
            Rule("l_orderkey", unique=True),
        ],
    )


@query(
    "path_parts",
    """
    SELECT page_id, p[-3] AS third_last, p[-1] AS last, split_part(p[-1], '?', 1) AS file
    FROM (SELECT page_id, string_split(url, '/') AS p FROM pages)
    """,
)
def path_parts(spark, sf):
    url = F.col("url")
    last = path_part(url, -1)
    return table(spark, sf, "pages").select(
        "page_id", path_part(url, -3).alias("third_last"), last.alias("last"),
        F.split_part(last, F.lit("?"), F.lit(1)).alias("file"),
    )


@query("version_stamp", "SELECT event_id, strftime(ts, '%y%m%d%H%M') AS stamp FROM events")
def stamps(spark, sf):
    return table(spark, sf, "events").select("event_id", version_stamp(F.col("ts")).alias("stamp"))


@query(
    "argmax_array",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS code FROM embeddings",
)
def argmax_array(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", argmax(F.col("embedding")).alias("code"))


@query(
    "probs_to_rows",
    """
    SELECT vec_id, CAST(i - 1 AS INTEGER) AS code, embedding[i] AS probability
    FROM embeddings, UNNEST(range(1, len(embedding) + 1)) AS r(i)
    """,
)
def probs_to_rows(spark, sf):
    return probabilities_to_rows(table(spark, sf, "embeddings"), ["vec_id"], "embedding")


@query(
    "metadata_map",
    """
    SELECT p_partkey, 'size' AS key, CAST(p_size AS VARCHAR) AS value FROM part
    UNION ALL SELECT p_partkey, 'brand', 'override' FROM part
    """,
)
def metadata(spark, sf):
    entries = {"name": F.col("p_name"), "size": F.col("p_size"), "brand": F.col("p_brand")}
    extra = F.create_map(F.lit("brand"), F.lit("override"))
    merged = metadata_map(entries, extra, drop=["name"])
    return table(spark, sf, "part").select("p_partkey", F.explode(merged).alias("key", "value"))


@query(
    "scale_difference",
    """
    SELECT p_partkey, (p_retailprice - (SELECT min(p_retailprice) FROM part))
      / ((SELECT max(p_retailprice) FROM part) - (SELECT min(p_retailprice) FROM part))
      - (CAST(p_size AS DOUBLE) - (SELECT min(p_size) FROM part))
      / ((SELECT max(p_size) FROM part) - (SELECT min(p_size) FROM part)) AS difference
    FROM part
    """,
)
def scale_difference(spark, sf):
    parts = table(spark, sf, "part")
    fitted = MinMax.fit(parts, ["p_retailprice", "p_size"])
    return parts.select("p_partkey", (fitted.scaled("p_retailprice") - fitted.scaled("p_size")).alias("difference"))
