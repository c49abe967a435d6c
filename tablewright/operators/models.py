"""Training, batch scoring and explanation of classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import argmax
from tablewright.operators.ranges import parts_for
from tablewright.operators.slicing import join_null_safe
from tablewright.sources.workspace import local_table

# Hidden layers, seed, search steps, probability that counts as
# reached, and size of the background sample.
HIDDEN = (32, 64, 128, 256)
SEED = 42
STEPS = 50
REACHED = 0.3
BACKGROUND = 100
POINTS_PER_TASK = 2_000_000  # points scored

Scorer = Callable[[DataFrame], DataFrame]  # adds an array column "probabilities"


def train_network(
    df: DataFrame, features: Sequence[str], label: str, n_classes: int, iterations: int = 2, seed: int = SEED
) -> PipelineModel:
    """A dense network over the feature columns, trained where the rows are."""
    network = MultilayerPerceptronClassifier(
        layers=[len(features), *HIDDEN, n_classes], maxIter=iterations, seed=seed, blockSize=128,
        featuresCol="_features", labelCol=label, probabilityCol="_probability",
    )
    return Pipeline(stages=[_assembler(features), network]).fit(df)


def train_logistic(df: DataFrame, features: Sequence[str], label: str, iterations: int = 20) -> PipelineModel:
    """A multinomial logistic model over the feature columns."""
    model = LogisticRegression(
        maxIter=iterations, regParam=1e-4, family="multinomial", featuresCol="_features", labelCol=label,
        probabilityCol="_probability",
    )
    return Pipeline(stages=[_assembler(features), model]).fit(df)


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")


def scorer(model: PipelineModel) -> Scorer:
    """A function that adds ``probabilities`` to a table of feature columns."""

    def score(df: DataFrame) -> DataFrame:
        scored = model.transform(df).withColumn("probabilities", vector_to_array("_probability"))
        return scored.select(*df.columns, "probabilities")

    return score


def foreign_scorer(load: Callable[[], Callable[[np.ndarray], np.ndarray]], features: Sequence[str]) -> Scorer:
    """The same for a model Spark does not know.

    ``load`` runs once per task and returns a function from a matrix of
    features to a matrix of probabilities; rows travel in Arrow batches.
    """
    features = list(features)

    def score(df: DataFrame) -> DataFrame:
        def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            predict = load()
            for frame in frames:
                matrix = frame[features].to_numpy(dtype=np.float32)
                yield frame.assign(probabilities=list(np.asarray(predict(matrix), dtype=np.float64)))

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return df.mapInPandas(batches, f"{fields}, probabilities array<double>")

    return score


def predict(df: DataFrame, score: Scorer) -> DataFrame:
    """Add the probabilities and the number of the most likely class."""
    return score(df).withColumn("predicted", argmax(F.col("probabilities")))


def _unit(*parts: Column) -> Column:
    """A repeatable number in [0, 1) from the given columns."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _spread(df: DataFrame, unique: str, points: int) -> DataFrame:
    """``df`` dealt by id into tasks that score a bounded number of points, so many of each row.

    A table in few files would else be multiplied in as few tasks. All points
    of an id are in one task, so what is grouped by it moves no more.
    """
    return df.repartition(parts_for(df, df.count() * points, POINTS_PER_TASK), unique)


def proposed(unique: str, name: str, steps: int = STEPS, seed: int = SEED) -> Column:
    """The value a feature (``_x_name``) gets in the seeded random proposal number ``_step`` of a row."""
    key = [F.col(unique), F.col("_step"), F.lit(f"{name}/{seed}")]
    reach = F.col("_step") / F.lit(float(steps))
    moves = _unit(*key, F.lit("moves")) < F.greatest(reach, F.lit(0.25))
    target = _unit(*key, F.lit("target"))
    amount = _unit(*key, F.lit("amount")) * reach
    moved = F.col(f"_x_{name}") + amount * (target - F.col(f"_x_{name}"))
    changed = F.least(F.lit(1.0), F.greatest(F.lit(0.0), moved))
    return F.when((F.col("_step") > 0) & moves, changed).otherwise(F.col(f"_x_{name}"))


def counterfactual_search(
    df: DataFrame, unique: str, features: Sequence[str], score: Scorer, class_index: int,
    threshold: float = REACHED, steps: int = STEPS, seed: int = SEED,
) -> DataFrame:
    """The least change of a row's features, within [0, 1], that reaches a probability.

    Every row gets ``steps`` seeded proposals: step by step more features may
    move, and each that does is drawn towards a random point of the domain.
    All proposals of all rows are scored as one table, those of a row in one task, and a grouped minimum
    of (distance, step) picks the nearest that reaches the threshold; proposal
    0 is the row itself. A proposal is a function of the row's id and the
    step, so the winner is built again rather than carried along. Result: one row per id and feature; ``proposed`` is null where
    no proposal got there.
    """
    features = list(features)
    proposal = lambda name: proposed(unique, name, steps, seed)

    base = df.select(unique, *[F.col(c).cast("double").alias(f"_x_{c}") for c in features])
    tried = _spread(base, unique, steps + 1).withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    tried = tried.withColumns({c: proposal(c) for c in features})
    distance = sum((F.abs(F.col(c) - F.col(f"_x_{c}")) for c in features), F.lit(0.0))
    scored = score(tried).withColumn("_p", F.col("probabilities")[class_index])
    reached = F.when(F.col("_p") >= F.lit(threshold), distance)
    best = scored.select(unique, "_step", *[f"_x_{c}" for c in features], reached.alias("_distance")).groupBy(unique).agg(
        F.min_by("_step", "_distance").alias("_step"),
        *[F.first(f"_x_{c}").alias(f"_x_{c}") for c in features],
    )
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"_x_{c}").alias("original"),
            F.when(F.col("_step").isNotNull(), proposal(c)).alias("proposed"),
        )
        for c in features
    ]
    long = best.select(unique, F.inline(F.array(*cells)))
    return long.withColumn("difference", F.col("proposed") - F.col("original"))


def background_sample(df: DataFrame, order_by: Sequence[str], features: Sequence[str], n: int = BACKGROUND) -> DataFrame:
    """The first ``n`` rows in the given order: the sample explanations compare with."""
    return df.orderBy(*order_by).limit(n).select(*features)


def background_mean(df: DataFrame, order_by: Sequence[str], features: Sequence[str], n: int = BACKGROUND) -> DataFrame:
    """Mean of every feature over the background sample."""
    sample = background_sample(df, order_by, features, n)
    one = sample.agg(*[F.avg(c).alias(c) for c in features])
    return one.unpivot([], list(features), "feature", "mean_background_value")


def feature_attribution(
    df: DataFrame, unique: str, features: Sequence[str], score: Scorer, background: DataFrame, n_classes: int,
    seed: int = SEED,
) -> DataFrame:
    """Share of each feature in each class probability, against a background.

    For a row and a background row, the features change from the background's
    value to the row's one after another, in a seeded random order of that
    pair; a feature's share is the mean change of the probability when its
    turn comes. The shares of a row sum exactly to f(row) minus the mean of f
    over the background. The background is a small sample (100 rows by
    default); rows are dealt to tasks by their id, pairs are made there by
    exploding its indices and joining on them, and all probabilities of a row
    collapse to sums in the same task.
    """
    features = list(features)
    sample = [tuple(float(v) for v in r) for r in background.select(*features).collect()]
    rows = [(i, *r) for i, r in enumerate(sample)]
    fields = ", ".join(["_b int", *[f"_b_{c} double" for c in features]])
    table = local_table(df.sparkSession, rows, fields)

    base = df.select(unique, *[F.col(c).cast("double").alias(f"_x_{c}") for c in features])
    base = _spread(base, unique, max(len(rows), 1) * (len(features) + 1))
    paired = join_null_safe(
        base.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(len(rows) - 1)))), F.broadcast(table), ["_b"], "inner"
    )
    draws = [F.xxhash64(F.col(unique), F.col("_b"), F.lit(f"{c}/{seed}")) for c in features]
    paired = paired.withColumns({f"_d_{c}": d for c, d in zip(features, draws)})
    turn = {}
    for j, c in enumerate(features):
        earlier = F.lit(1)
        for k, other in enumerate(features):
            if k != j:
                before = F.col(f"_d_{other}") < F.col(f"_d_{c}")
                if k < j:
                    before = F.col(f"_d_{other}") <= F.col(f"_d_{c}")
                earlier = earlier + before.cast("int")
        turn[f"_turn_{c}"] = earlier
    stepped = paired.withColumns(turn).withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    mixed = stepped.withColumns(
        {c: F.when(F.col(f"_turn_{c}") <= F.col("_at"), F.col(f"_x_{c}")).otherwise(F.col(f"_b_{c}")) for c in features}
    )
    keep = [unique, "_at", *[f"_x_{c}" for c in features], *[f"_turn_{c}" for c in features]]
    scored = score(mixed.select(*keep, *features))
    sums = []
    for c in features:
        sign = (F.col("_at") == F.col(f"_turn_{c}")).cast("int") - (F.col("_at") == F.col(f"_turn_{c}") - 1).cast("int")
        for k in range(n_classes):
            sums.append(F.sum(F.col("probabilities")[k] * sign).alias(f"_s_{c}_{k}"))
    base_value = [
        F.sum(F.when(F.col("_at") == 0, F.col("probabilities")[k])).alias(f"_f0_{k}") for k in range(n_classes)
    ]
    collapsed = scored.groupBy(unique).agg(*sums, *base_value, *[F.first(f"_x_{c}").alias(f"_x_{c}") for c in features])
    m = F.lit(float(len(rows)))
    cells = [
        F.struct(
            F.lit(k).alias("class_index"),
            F.lit(c).alias("feature"),
            F.col(f"_x_{c}").alias("value"),
            (F.col(f"_s_{c}_{k}") / m).alias("contribution"),
            (F.col(f"_f0_{k}") / m).alias("base_value"),
        )
        for k in range(n_classes)
        for c in features
    ]
    return collapsed.select(unique, F.inline(F.array(*cells)))
