"""Drift, quality gate and metrics log."""

from pyspark.sql import functions as F

from tablewright.operators import monitor
from tablewright.sources.workspace import new_dir
from tablewright.workloads.base import LINE_FEATURES, LINE_SQL, line_features, query, table

SHIFT = (
    f"WITH l AS (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN 'a' ELSE 'b' END AS tag FROM ({LINE_SQL}))"
    ", m AS ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) FILTER (tag = 'a') AS n_ref, count({c}) FILTER (tag = 'b') AS n_live,
        avg({c}) FILTER (tag = 'a') AS mean_ref, avg({c}) FILTER (tag = 'b') AS mean_live,
        var_samp({c}) FILTER (tag = 'a') AS var_ref, var_samp({c}) FILTER (tag = 'b') AS var_live FROM l"""
        for c in LINE_FEATURES
    )
    + """)
    SELECT column_name, n_ref, n_live, mean_ref, mean_live,
      round((mean_live - mean_ref) / sqrt(var_ref / n_ref + var_live / n_live), 6) AS t,
      round(power(var_ref / n_ref + var_live / n_live, 2) / (power(var_ref / n_ref, 2) / (n_ref - 1)
        + power(var_live / n_live, 2) / (n_live - 1)), 3) AS dof FROM m"""
)


def tagged(spark, sf):
    rows = line_features(spark, sf, "l_shipdate")
    early = F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    return rows.withColumn("tag", F.when(early, "TRAINING").otherwise("LIVE"))


@query("drift_meanshift", SHIFT)
def drift_meanshift(spark, sf):
    out = monitor.mean_shift(tagged(spark, sf), "tag", LINE_FEATURES)
    return out.select(
        "column_name", "n_ref", "n_live", "mean_ref", "mean_live", F.round("t", 6).alias("t"), F.round("dof", 3).alias("dof")
    )


@query("drift_p_value")
def drift_p_value(spark, sf):
    out = monitor.with_p_value(monitor.mean_shift(tagged(spark, sf), "tag", LINE_FEATURES))
    return out.select("column_name", "t", "dof", "p_value", "drifted")


@query(
    "quality_gate",
    """
    WITH v AS (
      SELECT o_orderpriority AS model, o_orderkey AS version_id, o_totalprice / 1000000 AS accuracy,
        o_orderstatus = 'F' AS prod FROM orders
    ), p AS (
      SELECT model, accuracy AS previous_accuracy FROM v
      QUALIFY row_number() OVER (PARTITION BY model ORDER BY prod DESC, version_id DESC) = 1
    ), c AS (
      SELECT o_orderpriority AS model, count(*) FILTER (o_orderstatus = 'O') / count(*) AS accuracy FROM orders GROUP BY 1
      UNION ALL SELECT 'unseen', count(*) FILTER (o_orderstatus = 'none') / count(*) FROM orders
    )
    SELECT c.model, accuracy, coalesce(previous_accuracy, 0.1) AS previous_accuracy, accuracy > 0.01 AS passed,
      accuracy > coalesce(previous_accuracy, 0.1) AS beats_previous
    FROM c LEFT JOIN p ON c.model = p.model
    """,
)
def quality_gate(spark, sf):
    orders = table(spark, sf, "orders")
    versions = orders.selectExpr(
        "o_orderpriority AS model", "o_orderkey AS version_id", "o_totalprice / 1000000 AS accuracy",
        "o_orderstatus = 'F' AS prod",
    )
    candidates = orders.groupBy(F.col("o_orderpriority").alias("model")).agg(
        (F.count_if(F.col("o_orderstatus") == "O") / F.count(F.lit(1))).alias("accuracy")
    )
    unseen = orders.agg(
        (F.count_if(F.col("o_orderstatus") == "none") / F.count(F.lit(1))).alias("accuracy")
    ).withColumn("model", F.lit("unseen"))
    return monitor.quality_gate(versions, F.col("model"), F.col("accuracy"), candidates.unionByName(unseen))


@query(
    "metrics_log",
    """
    WITH m AS (SELECT CAST(label AS BIGINT) AS version_id, count(*) FILTER (list_sum(embedding) > 0) / count(*) AS accuracy,
               CAST(count(*) AS DOUBLE) AS n FROM embeddings GROUP BY label)
    SELECT 'vectors' AS model, version_id, 'accuracy' AS metric, accuracy AS value,
      md5(CAST(version_id AS VARCHAR)) AS fingerprint, version_id % 2 = 0 AS prod FROM m
    UNION ALL SELECT 'vectors', version_id, 'rows', n, md5(CAST(version_id AS VARCHAR)), version_id % 2 = 0 FROM m
    """,
)
def metrics_log(spark, sf):
    measured = table(spark, sf, "embeddings").groupBy(F.col("label").cast("bigint").alias("version_id")).agg(
        (F.count_if(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double")) > 0) / F.count(F.lit(1))).alias("accuracy"),
        F.count(F.lit(1)).cast("double").alias("rows"),
    )
    log = monitor.MetricsLog(spark, new_dir(spark, "metrics"))
    for metric in ("accuracy", "rows"):
        log.append(
            measured.select(
                F.lit("vectors").alias("model"), "version_id", F.lit(metric).alias("metric"),
                F.col(metric).alias("value"), F.md5(F.col("version_id").cast("string")).alias("fingerprint"),
                (F.col("version_id") % 2 == 0).alias("prod"),
            )
        )
    return log.read()
