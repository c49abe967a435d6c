"""Training, scoring and explanation."""

import numpy as np
from pyspark.sql import functions as F

from tablewright.operators import models as m
from tablewright.operators.counterfactual import nearest_counterfactual
from tablewright.operators.joins import lookup
from tablewright.operators.online_index import IndexedTable
from tablewright.operators.ordering import sorted_codes
from tablewright.operators.prep import MinMax, encode_labels
from tablewright.operators.training import train_network
from tablewright.workloads.base import query, table
from tablewright.workloads.preparation import COUNTRY_FEATURES, country_training_set

FEATURES = ["size", "price"]


@query("train_classifier")
def train_classifier(spark, sf):
    """Train the dense network on the train rows, two epochs by two tasks, and predict the test rows."""
    data = country_training_set(spark, sf)
    train = data.table.where("split = 'train'")
    model = train_network(train, COUNTRY_FEATURES, "code", data.codes.count(), "o_orderkey", workers=2, every=32)
    test = data.table.where("split = 'test'")
    return m.predict(test, m.foreign_scorer(model.loader(), COUNTRY_FEATURES)).select("o_orderkey", "code", "predicted")


def part_model(spark, sf):
    """Scaled part rows and a logistic model of their type."""
    parts = table(spark, sf, "part").selectExpr(
        "p_partkey", "p_name", "p_type", "CAST(p_size AS DOUBLE) AS size", "p_retailprice AS price"
    )
    coded = encode_labels(parts, "p_type")
    scaler = MinMax.fit(coded, FEATURES)
    scaled = scaler.transform(coded)
    codes = sorted_codes(parts, "p_type")
    return scaled, scaler, m.train_logistic(scaled, FEATURES, "code"), codes.count()


@query("score_batch")
def score_batch(spark, sf):
    scaled, _, model, _ = part_model(spark, sf)
    scored = m.predict(scaled.select("p_partkey", *FEATURES), m.scorer(model))
    return scored.select("p_partkey", "predicted", F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x).alias("total"))


def load_rule():
    """A model outside Spark: two classes by a fixed linear rule."""

    def predict(x: np.ndarray) -> np.ndarray:
        p = 1.0 / (1.0 + np.exp(-(x[:, 0] - x[:, 1])))
        return np.stack([1.0 - p, p], axis=1)

    return predict


@query(
    "score_foreign",
    """
    SELECT p_partkey, CASE WHEN CAST(p_size AS DOUBLE) > p_retailprice / 40 THEN 1 ELSE 0 END::BIGINT AS predicted FROM part
    """,
)
def score_foreign(spark, sf):
    rows = table(spark, sf, "part").selectExpr("p_partkey", "CAST(p_size AS DOUBLE) AS size", "p_retailprice / 40 AS price")
    return m.predict(rows, m.foreign_scorer(load_rule, FEATURES)).select("p_partkey", "predicted")


@query("counterfactual_search")
def counterfactual(spark, sf):
    scaled, _, model, _ = part_model(spark, sf)
    return nearest_counterfactual(scaled, "p_partkey", FEATURES, m.scorer(model), class_index=0, rounds=6)


@query("feature_attribution")
def attribution(spark, sf):
    scaled, _, model, n_classes = part_model(spark, sf)
    background = m.background_sample(scaled, ["p_partkey"], FEATURES)
    return m.feature_attribution(scaled, "p_partkey", FEATURES, m.scorer(model), background, n_classes)


@query("entity_key_only_predict")
def entity_key_only_predict(spark, sf):
    """From keys alone: look the features up, scale them, score them."""
    _, scaler, model, _ = part_model(spark, sf)
    snapshot = table(spark, sf, "part").selectExpr("p_partkey", "CAST(p_size AS DOUBLE) AS size", "p_retailprice AS price")
    keys = table(spark, sf, "lineitem").selectExpr("l_partkey AS p_partkey").distinct()
    found = lookup(keys, snapshot, "p_partkey", FEATURES)
    return m.predict(scaler.transform(found), m.scorer(model)).select("p_partkey", "predicted")


def linear_parts(spark, sf):
    """Scaled part rows and two class probabilities by a fixed linear rule of them."""
    parts = table(spark, sf, "part").selectExpr("p_partkey", "CAST(p_size AS DOUBLE) AS size", "p_retailprice AS price")
    scaled = MinMax.fit(parts, FEATURES).transform(parts)

    def score(df):
        p = 0.25 * F.col("size") + 0.75 * F.col("price")
        return df.withColumn("probabilities", F.array(1 - p, p))

    return scaled, score


LINEAR = """
WITH raw AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part),
b AS (SELECT min(size) AS s0, max(size) AS s1, min(price) AS p0, max(price) AS p1 FROM raw),
x AS (SELECT p_partkey, (size - s0) / (s1 - s0) AS size, (price - p0) / (p1 - p0) AS price FROM raw, b)
"""


@query(
    "attribution_linear",
    LINEAR
    + """, g AS (SELECT avg(size) AS size, avg(price) AS price FROM (SELECT * FROM x ORDER BY p_partkey LIMIT 100))
    SELECT p_partkey, k AS class_index, f AS feature,
      round((2 * k - 1) * CASE WHEN f = 'size' THEN 0.25 * (x.size - g.size) ELSE 0.75 * (x.price - g.price) END, 6)
        AS contribution
    FROM x, g, (VALUES (0), (1)) AS c(k), (VALUES ('size'), ('price')) AS n(f)
    """,
)
def attribution_linear(spark, sf):
    """Of a linear rule, a feature's share is its weight times the distance from the background's mean."""
    scaled, score = linear_parts(spark, sf)
    background = m.background_sample(scaled, ["p_partkey"], FEATURES)
    out = m.feature_attribution(scaled, "p_partkey", FEATURES, score, background, 2)
    return out.select("p_partkey", "class_index", "feature", (F.round("contribution", 6) + 0.0).alias("contribution"))


@query(
    "score_linear",
    LINEAR
    + """SELECT p_partkey, CASE WHEN 0.25 * size + 0.75 * price > 0.5 THEN 1 ELSE 0 END AS predicted,
      round(0.25 * size + 0.75 * price, 9) AS probability FROM x""",
)
def score_linear(spark, sf):
    scaled, score = linear_parts(spark, sf)
    out = m.predict(scaled, score)
    return out.select("p_partkey", "predicted", F.round(F.col("probabilities")[1], 9).alias("probability"))


@query(
    "counterfactual_validity",
    LINEAR
    + """SELECT p_partkey, true AS inside, true AS reached, 0.25 * size + 0.75 * price >= 0.3 AS unchanged FROM x""",
)
def counterfactual_validity(spark, sf):
    """Every proposal stays inside the domain and reaches the threshold; rows that had reached it stay as they are."""
    scaled, score = linear_parts(spark, sf)
    found = m.counterfactual_search(scaled, "p_partkey", FEATURES, score, class_index=1)
    wide = found.groupBy("p_partkey").agg(
        F.min(F.col("proposed").between(0, 1)).alias("inside"),
        F.max(F.when(F.col("feature") == "size", F.col("proposed"))).alias("size"),
        F.max(F.when(F.col("feature") == "price", F.col("proposed"))).alias("price"),
        F.min(F.col("difference") == 0).alias("unchanged"),
    )
    return score(wide).select(
        "p_partkey", "inside", (F.col("probabilities")[1] >= m.REACHED).alias("reached"), "unchanged"
    )


@query(
    "counterfactual_nearest",
    LINEAR
    + """SELECT p_partkey, true AS reached, round(CASE
        WHEN 0.25 * size + 0.75 * price >= 0.6 THEN 0
        WHEN 0.25 * size + 0.75 >= 0.6 THEN (0.6 - 0.25 * size - 0.75 * price) / 0.75
        ELSE 1 - price + (0.6 - 0.25 * size - 0.75) / 0.25 END, 6) AS nearest, true AS near
      FROM x""",
)
def counterfactual_nearest(spark, sf):
    """Of a linear rule the nearest point is known: the heavier feature moves first. The search ends within 0.001 of it."""
    scaled, score = linear_parts(spark, sf)
    found = nearest_counterfactual(scaled, "p_partkey", FEATURES, score, 1, threshold=0.6, rounds=6)
    distance = found.groupBy("p_partkey").agg(
        F.min(F.col("proposed").isNotNull()).alias("reached"), F.sum(F.abs("difference")).alias("_found")
    )
    rest = 0.6 - 0.25 * F.col("size") - 0.75 * F.col("price")
    nearest = F.when(rest <= 0, 0.0).when(0.25 * F.col("size") + 0.75 >= 0.6, rest / 0.75).otherwise(
        1 - F.col("price") + (0.6 - 0.25 * F.col("size") - 0.75) / 0.25
    )
    both = scaled.withColumn("_nearest", nearest).join(distance, "p_partkey")
    near = F.col("_found").between(F.col("_nearest") - 1e-9, F.col("_nearest") + 1e-3)
    return both.select("p_partkey", "reached", F.round("_nearest", 6).alias("nearest"), near.alias("near"))


@query(
    "entity_key_only_linear",
    LINEAR
    + """SELECT DISTINCT l_partkey AS p_partkey, CASE WHEN 0.25 * size + 0.75 * price > 0.5 THEN 1 ELSE 0 END AS predicted
      FROM lineitem JOIN x ON p_partkey = l_partkey""",
)
def entity_key_only_linear(spark, sf):
    """From keys alone, by a fixed rule: features from the indexed serving table, scaled and scored."""
    parts = table(spark, sf, "part").selectExpr("p_partkey", "CAST(p_size AS DOUBLE) AS size", "p_retailprice AS price")
    _, score = linear_parts(spark, sf)
    stored = IndexedTable(spark, ["p_partkey"], rows_per_bucket=500)
    stored.write(parts)
    found = stored.lookup(table(spark, sf, "lineitem").selectExpr("l_partkey AS p_partkey").distinct(), FEATURES)
    scaled = MinMax.fit(parts, FEATURES).transform(found)
    return m.predict(scaled, score).select("p_partkey", "predicted")
