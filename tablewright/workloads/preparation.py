"""Encoding, splitting, scaling and the training set."""

from pyspark.sql import functions as F

from tablewright.operators import prep
from tablewright.operators.columns import Rule
from tablewright.plans.training import training_set
from tablewright.workloads.base import LINE_FEATURES, LINE_SQL, line_features, query, table
from tablewright.workloads.scans import SPLIT_ORDERS


@query(
    "encode_labels",
    """
    SELECT event_id, event_type, code FROM events JOIN (
      SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code
      FROM (SELECT DISTINCT event_type FROM events)) USING (event_type)
    """,
)
def encode_labels(spark, sf):
    return prep.encode_labels(table(spark, sf, "events").select("event_id", "event_type"), "event_type")


@query(
    "one_hot",
    """
    SELECT vec_id, CAST(i AS INTEGER) AS code, CAST(i = label AS INTEGER)::DOUBLE AS value
    FROM embeddings, UNNEST(range(0, 10)) AS r(i)
    """,
)
def one_hot(spark, sf):
    coded = table(spark, sf, "embeddings").select("vec_id", prep.one_hot(F.col("label"), 10).alias("v"))
    return coded.select("vec_id", F.posexplode("v").alias("code", "value"))


@query(
    "split_ordered",
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) > count(*) OVER ()
      - (count(*) OVER () * 20 + 99) // 100 AS is_test FROM orders
    """,
)
def split_ordered(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return prep.split_ordered(rows, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "split_stratified",
    """
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY
        md5(concat_ws('/', CAST(event_id AS VARCHAR), '42')), event_id)
      <= (count(*) OVER (PARTITION BY event_type) * 20 + 50) // 100 AS is_val FROM events
    """,
)
def split_stratified(spark, sf):
    return prep.split_stratified(
        table(spark, sf, "events").select("event_id", "event_type"), "event_type", "event_id"
    )


@query(
    "split_stratified_hot_classes",
    """
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY
        md5(concat_ws('/', CAST(event_id AS VARCHAR), '42')), event_id)
      <= (count(*) OVER (PARTITION BY event_type) * 20 + 50) // 100 AS is_val FROM events
    """,
)
def split_stratified_hot_classes(spark, sf):
    """The same with every class cut into slices, of which one is sorted."""
    rows = table(spark, sf, "events").select("event_id", "event_type")
    return prep.split_stratified(rows, "event_type", "event_id", rows_per_slice=50)


@query(
    "shuffle_seeded",
    """
    SELECT event_id, position, position // 32 AS batch FROM (
      SELECT event_id, row_number() OVER (ORDER BY md5(concat_ws('/', CAST(event_id AS VARCHAR), '42')), event_id) - 1
        AS position FROM events)
    """,
)
def shuffle_seeded(spark, sf):
    return prep.shuffled(table(spark, sf, "events").select("event_id"), "event_id")


@query(
    "minmax_transform",
    f"WITH l AS ({LINE_SQL}), m AS (SELECT "
    + ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in LINE_FEATURES)
    + " FROM l WHERE l_shipdate < TIMESTAMP '2000-01-01') SELECT l_partkey, l_suppkey, l_shipdate, "
    + ", ".join(f"({c} - {c}_lo) / ({c}_hi - {c}_lo) AS {c}" for c in LINE_FEATURES)
    + " FROM l CROSS JOIN m",
)
def minmax_transform(spark, sf):
    rows = line_features(spark, sf, "l_partkey", "l_suppkey", "l_shipdate")
    fitted = prep.MinMax.fit(rows.where("l_shipdate < TIMESTAMP_NTZ '2000-01-01'"), LINE_FEATURES)
    return fitted.transform(rows)


@query(
    "compare_predictions",
    """
    SELECT vec_id, CAST(i - 1 AS INTEGER) AS position, a, b FROM (
      SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS a,
        CAST(embedding[i] AS DOUBLE) + CASE WHEN embedding[i] > 0.2 THEN 0.001 ELSE 0.0000001 END AS b
      FROM embeddings, UNNEST(range(1, len(embedding) + 1)) AS r(i))
    WHERE abs(a - b) > 0.00001 + 0.00001 * abs(b)
    """,
)
def compare_predictions(spark, sf):
    first = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("p"))
    second = first.withColumn(
        "p", F.transform("p", lambda x: x + F.when(x > F.lit(0.2).cast("float"), 0.001).otherwise(0.0000001))
    )
    return prep.compare_predictions(first, second, ["vec_id"], "p")


@query(
    "training_set",
    """
    WITH joined AS (
      SELECT o_orderkey, n_name AS country, round(o_totalprice * 100) AS price_cents, c_acctbal AS balance,
        nullif(c_custkey % 7, 3) AS score
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    ), complete AS (
      SELECT * FROM joined WHERE country IS NOT NULL AND price_cents IS NOT NULL AND balance IS NOT NULL
        AND score IS NOT NULL
    ), codes AS (
      SELECT country, row_number() OVER (ORDER BY country) - 1 AS code FROM (SELECT DISTINCT country FROM complete)
    ), ranked AS (
      SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM complete
    ), rest AS (
      SELECT *, row_number() OVER (PARTITION BY country ORDER BY
          md5(concat_ws('/', CAST(o_orderkey AS VARCHAR), '42')), o_orderkey) AS vr,
        count(*) OVER (PARTITION BY country) AS vn
      FROM ranked WHERE rn <= n - (n * 20 + 99) // 100
    ), parted AS (
      SELECT o_orderkey, CASE WHEN vr <= (vn * 20 + 50) // 100 THEN 'val' ELSE 'train' END AS split FROM rest
      UNION ALL SELECT o_orderkey, 'test' FROM ranked WHERE rn > n - (n * 20 + 99) // 100
    ), m AS (
      SELECT min(price_cents) AS p0, max(price_cents) AS p1, min(balance) AS b0, max(balance) AS b1,
        CAST(min(score) AS DOUBLE) AS s0, CAST(max(score) AS DOUBLE) AS s1
      FROM complete JOIN parted USING (o_orderkey) WHERE split = 'train'
    )
    SELECT o_orderkey, country, code, split, (price_cents - p0) / (p1 - p0) AS price_cents,
      (balance - b0) / (b1 - b0) AS balance, (CAST(score AS DOUBLE) - s0) / (s1 - s0) AS score
    FROM complete JOIN parted USING (o_orderkey) JOIN codes USING (country) CROSS JOIN m
    """,
)
def training(spark, sf):
    return country_training_set(spark, sf).table


COUNTRY_FEATURES = ["price_cents", "balance", "score"]


def country_training_set(spark, sf):
    rankings = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey AS customer", "rint(o_totalprice * 100) AS price_cents"
    )
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    properties = (
        table(spark, sf, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .selectExpr("c_custkey AS customer", "country", "c_acctbal AS balance", "nullif(c_custkey % 7, 3) AS score")
    )
    return training_set(
        rankings, properties, "customer", "country", COUNTRY_FEATURES, "o_orderkey",
        rules=[Rule("country", not_null=True), Rule("score", low=0, high=6)],
    )


@query(
    "split_scaled_ranges",
    SPLIT_ORDERS
    + """, m AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM parted WHERE split = 'train')
    SELECT split, count(*) AS n, min((o_totalprice - lo) / (hi - lo)) AS low, max((o_totalprice - lo) / (hi - lo)) AS high
    FROM parted CROSS JOIN m GROUP BY split
    """,
)
def split_scaled_ranges(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    parts = prep.split(rows, ["o_orderkey"], "o_orderpriority", "o_orderkey")
    fitted = prep.MinMax.fit(parts.where("split = 'train'"), ["o_totalprice"])
    return fitted.transform(parts).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high")
    )


@query(
    "compare_predictions_one_sided",
    """
    SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 0 END AS INT) AS position,
      CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice END AS a, CASE WHEN o_orderkey % 3 = 2 THEN o_totalprice END AS b
    FROM orders
    """,
)
def compare_one_sided(spark, sf):
    """Rows that one side has: some with an element, some with an empty array."""
    orders = table(spark, sf, "orders")
    none = F.array().cast("array<double>")
    a = orders.where("o_orderkey % 3 <> 2").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 1, F.array("o_totalprice")).otherwise(none).alias("v")
    )
    b = orders.where("o_orderkey % 3 = 2").select("o_orderkey", F.array("o_totalprice").alias("v"))
    return prep.compare_predictions(a, b, ["o_orderkey"], "v")


@query(
    "split_ordered_by_price",
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) > count(*) OVER ()
      - (count(*) OVER () * 20 + 99) // 100 AS is_test FROM orders
    """,
)
def split_by_price(spark, sf):
    """An order that begins with a double."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return prep.split_ordered(orders, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "is_test")
