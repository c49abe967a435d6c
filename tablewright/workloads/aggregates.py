"""Summaries and classification metrics."""

from pyspark.sql import functions as F

from tablewright.functions.scalars import argmax
from tablewright.operators import aggs
from tablewright.operators.models import background_mean
from tablewright.operators.prep import MinMax
from tablewright.workloads.base import LINE_FEATURES, LINE_SQL, line_features, query, table


DESCRIBE = (
    f"WITH l AS ({LINE_SQL}) "
    + " UNION ALL ".join(
        f"""
        SELECT '{c}' AS column_name, count({c}) AS "count", avg({c}) AS mean, round(stddev_samp({c}), 3) AS std,
          min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
          quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM l
        """
        for c in LINE_FEATURES
    )
)


@query("describe_t", DESCRIBE)
def describe_t(spark, sf):
    out = aggs.describe(line_features(spark, sf), LINE_FEATURES)
    return out.withColumn("std", F.round("std", 3))


@query("describe_large", DESCRIBE)
def describe_large(spark, sf):
    """The same over more partitions: quartiles are found alike at every size."""
    out = aggs.describe(line_features(spark, sf).repartition(16), LINE_FEATURES)
    return out.withColumn("std", F.round("std", 3))


@query(
    "distinct_values",
    "SELECT DISTINCT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey "
    "JOIN lineitem ON l_suppkey = s_suppkey",
)
def distinct_values(spark, sf):
    used = table(spark, sf, "lineitem").select("l_suppkey").distinct()
    suppliers = table(spark, sf, "supplier").join(used, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi")
    nations = table(spark, sf, "nation")
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name").distinct()


CORR = ["quantity", "price_cents", "discount_pct", "tax_pct", "one"]


def _r(x: str, y: str) -> str:
    if "one" in (x, y):
        return "CAST(NULL AS DOUBLE)"
    return "1.0" if x == y else f"(SELECT round(corr({x}, {y}), 6) FROM l)"


@query(
    "corr_target",
    f"WITH l AS ({LINE_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, " + (_r(c, "price_cents") if c != "price_cents" else "1.0") + "::DOUBLE AS r"
        for c in CORR
    ),
)
def corr_target(spark, sf):
    rows = line_features(spark, sf).withColumn("one", F.lit(1))
    return aggs.corr_target(rows, CORR, "price_cents").withColumn("r", F.round("r", 6))


@query(
    "corr_matrix",
    f"WITH l AS ({LINE_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {_r(*sorted((x, y)))}::DOUBLE AS r" for x in CORR for y in CORR
    ),
)
def corr_matrix(spark, sf):
    rows = line_features(spark, sf).withColumn("one", F.lit(1))
    return aggs.corr_matrix(rows, CORR).withColumn("r", F.round("r", 6))


@query(
    "group_mean_all",
    f"""
    SELECT n_name AS country, avg(quantity) AS quantity, avg(price_cents) AS price_cents,
      avg(discount_pct) AS discount_pct, avg(tax_pct) AS tax_pct
    FROM ({LINE_SQL}) JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY n_name ORDER BY n_name
    """,
)
def group_mean_all(spark, sf):
    rows = line_features(spark, sf, "l_suppkey")
    countries = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    joined = rows.join(countries, F.col("l_suppkey") == F.col("s_suppkey")).withColumnRenamed("n_name", "country")
    return aggs.group_mean(joined, ["country"], LINE_FEATURES).orderBy("country")


@query(
    "group_mean",
    "SELECT p_name, avg(round(l_extendedprice * 100)) AS popularity FROM lineitem "
    "JOIN part ON l_partkey = p_partkey GROUP BY p_name",
)
def group_mean(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_partkey", "rint(l_extendedprice * 100) AS popularity")
    names = table(spark, sf, "part").select("p_partkey", "p_name")
    joined = rows.join(names, F.col("l_partkey") == F.col("p_partkey"))
    return aggs.group_mean(joined, ["p_name"], ["popularity"])


@query(
    "group_mean_null_keys",
    "SELECT nullif(l_linenumber, 1) AS line, avg(l_quantity) AS quantity FROM lineitem "
    "WHERE l_linenumber <> 1 GROUP BY 1",
)
def group_mean_null_keys(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("nullif(l_linenumber, 1) AS line", "l_quantity AS quantity")
    return aggs.group_mean(rows, ["line"], ["quantity"])


def vector_predictions(spark, sf):
    """Embedding rows as predictions: the class is the largest value's place."""
    return table(spark, sf, "embeddings").select(
        F.col("label").cast("bigint").alias("actual"), argmax("embedding").alias("predicted")
    )


VECTORS = """
WITH p AS (SELECT CAST(label AS BIGINT) AS actual,
  CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS predicted FROM embeddings)
"""


@query("accuracy", VECTORS + "SELECT count(*) FILTER (actual = predicted) / count(*) AS accuracy FROM p")
def accuracy(spark, sf):
    return aggs.accuracy(vector_predictions(spark, sf), "actual", "predicted")


@query(
    "confusion_matrix",
    VECTORS
    + "SELECT actual, predicted, count(*) AS n FROM p GROUP BY actual, predicted",
)
def confusion_matrix(spark, sf):
    return aggs.confusion_matrix(vector_predictions(spark, sf), "actual", "predicted")


@query(
    "confusion_matrix_declared",
    VECTORS
    + """, c AS (SELECT unnest(range(64)) AS label)
    SELECT a.label AS actual, b.label AS predicted, count(p.actual) AS n
    FROM c a CROSS JOIN c b LEFT JOIN p ON p.actual = a.label AND p.predicted = b.label
    GROUP BY a.label, b.label
    """,
)
def confusion_matrix_declared(spark, sf):
    """All pairs of the classes that a vector's places name."""
    return aggs.confusion_matrix(vector_predictions(spark, sf), "actual", "predicted", list(range(64)))


GAPS = """
WITH l AS (SELECT l_quantity + CASE WHEN l_linenumber = 1 THEN 1e9 ELSE 0 END AS a,
  CASE WHEN l_linenumber > 1 THEN l_extendedprice END AS b, l_discount AS c FROM lineitem),
cells AS (SELECT 'a' AS x, 'b' AS y, corr(a, b) AS r FROM l WHERE b IS NOT NULL
  UNION ALL SELECT 'b', 'c', corr(b, c) FROM l WHERE b IS NOT NULL)
SELECT x, y, round(r, 6) AS r FROM cells UNION ALL SELECT y, x, round(r, 6) FROM cells
"""


@query("corr_matrix_gaps", GAPS)
def corr_matrix_gaps(spark, sf):
    """A column whose unpaired rows lie far from the paired ones."""
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_quantity + IF(l_linenumber = 1, 1e9D, 0D) AS a", "IF(l_linenumber > 1, l_extendedprice, NULL) AS b", "l_discount AS c"
    )
    out = aggs.corr_matrix(rows, ["a", "b", "c"]).withColumn("r", F.round("r", 6))
    return out.where("(x = 'b') <> (y = 'b')")


@query(
    "precision_recall",
    VECTORS
    + """, c AS (SELECT DISTINCT actual AS label FROM p UNION SELECT DISTINCT predicted FROM p)
    , m AS (SELECT label, (SELECT count(*) FROM p WHERE actual = label) AS n_actual,
      (SELECT count(*) FROM p WHERE predicted = label) AS n_predicted,
      (SELECT count(*) FROM p WHERE predicted = label AND actual = label) AS n_right FROM c)
    SELECT label, n_actual, n_predicted, n_right,
      CASE WHEN n_predicted > 0 THEN n_right / n_predicted END AS "precision",
      CASE WHEN n_actual > 0 THEN n_right / n_actual END AS recall FROM m
    """,
)
def precision_recall(spark, sf):
    return aggs.precision_recall(vector_predictions(spark, sf), "actual", "predicted")


@query(
    "precision_recall_threshold",
    """
    SELECT count(*) FILTER (value > 30 AND event_type = 'purchase') / count(*) FILTER (value > 30) AS "precision",
      count(*) FILTER (value > 30 AND event_type = 'purchase') / count(*) FILTER (event_type = 'purchase') AS recall
    FROM events
    """,
)
def precision_recall_threshold(spark, sf):
    return aggs.binary_precision_recall(
        table(spark, sf, "events"), F.col("event_type") == "purchase", F.col("value"), 30.0
    )


@query(
    "class_weights",
    """
    SELECT event_type AS label, count(*) AS n,
      (SELECT count(*) FROM events) / ((SELECT count(DISTINCT event_type) FROM events) * count(*)) AS weight
    FROM events GROUP BY event_type
    """,
)
def class_weights(spark, sf):
    return aggs.class_weights(table(spark, sf, "events"), "event_type")


@query(
    "minmax_fit",
    f"WITH l AS ({LINE_SQL} WHERE l_shipdate < TIMESTAMP '2000-01-01') "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, min({c}) AS min, max({c}) AS max FROM l" for c in LINE_FEATURES),
)
def minmax_fit(spark, sf):
    train = line_features(spark, sf, "l_shipdate").where("l_shipdate < TIMESTAMP_NTZ '2000-01-01'")
    return MinMax.fit(train, LINE_FEATURES).table(spark)


@query(
    "background_mean",
    """
    WITH b AS (SELECT round(o_totalprice * 100) AS price_cents, CAST(o_custkey AS DOUBLE) AS custkey
               FROM orders ORDER BY o_orderkey LIMIT 100)
    SELECT 'price_cents' AS feature, avg(price_cents) AS mean_background_value FROM b
    UNION ALL SELECT 'custkey', avg(custkey) FROM b
    """,
)
def background(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "rint(o_totalprice * 100) AS price_cents", "CAST(o_custkey AS DOUBLE) AS custkey"
    )
    return background_mean(rows, ["o_orderkey"], ["price_cents", "custkey"])


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))
