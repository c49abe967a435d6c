"""Drift, quality gate and the metrics log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.stats import t_p_value
from tablewright.sources.workspace import local_table

METRICS_SCHEMA = "model string, version_id bigint, metric string, value double, fingerprint string, prod boolean"
# The accuracy assumed without a previous version, the accuracy
# a version must exceed, and the p-value below which means have drifted.
DEFAULT_ACCURACY = 0.1
GATE = 0.01
DRIFT_LEVEL = 0.05


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """n, mean and sample variance per column and group, in long form."""
    parts = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        v = F.when(~F.isnan(v), v)
        spread = F.var_samp(v)
        # partial variances of equal values need not merge to exactly zero
        exact = F.when(spread.isNotNull() & (F.min(v) == F.max(v)), F.lit(0.0)).otherwise(spread)
        mean = F.when(F.min(v) == F.max(v), F.min(v)).otherwise(F.avg(v))
        parts += [F.count(v).alias(f"n_{i}"), mean.alias(f"mean_{i}"), exact.alias(f"var_{i}")]
    wide = df.groupBy(*by).agg(*parts)
    cells = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{s}_{i}").alias(s) for s in ("n", "mean", "var")])
        for i, c in enumerate(columns)
    ]
    return wide.select(*by, F.inline(F.array(*cells)))


def welch(pairs: DataFrame) -> DataFrame:
    """Add t and degrees of freedom for columns n, mean, var with _ref and _live."""
    a = F.try_divide(F.col("var_ref"), F.col("n_ref"))
    b = F.try_divide(F.col("var_live"), F.col("n_live"))
    t = F.try_divide(F.col("mean_live") - F.col("mean_ref"), F.sqrt(a + b))
    dof = F.try_divide((a + b) * (a + b), a * a / (F.col("n_ref") - 1) + b * b / (F.col("n_live") - 1))
    # a sample of one has no variance, so there is nothing to test
    enough = (F.col("n_ref") > 1) & (F.col("n_live") > 1)
    return pairs.withColumn("t", F.when(enough, t)).withColumn("dof", F.when(enough, dof))


def with_p_value(tested: DataFrame) -> DataFrame:
    """Add the two-sided p-value; two constant columns are equal (1) or not (0)."""
    constant = (F.col("var_ref") == 0) & (F.col("var_live") == 0)
    p = F.when(constant, (F.col("mean_ref") == F.col("mean_live")).cast("double")).otherwise(
        t_p_value(F.col("t"), F.col("dof"))
    )
    return tested.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < F.lit(DRIFT_LEVEL))


def mean_shift(df: DataFrame, tag: str, columns: Sequence[str], reference: str = "TRAINING") -> DataFrame:
    """Per column: does the mean of live rows differ from that of the reference rows.

    One grouped aggregate over the table; everything after it works on one
    row per column.
    """
    role = F.when(F.col(tag) == reference, "ref").otherwise("live").alias("_role")
    by_role = moments(df.select(role, *columns), columns, ["_role"])
    stats = ("n", "mean", "var")
    paired = by_role.groupBy("column_name").agg(
        *[F.max(F.when(F.col("_role") == r, F.col(s))).alias(f"{s}_{r}") for r in ("ref", "live") for s in stats]
    )
    return welch(paired)


def quality_gate(versions: DataFrame, model: Column, accuracy: Column, candidates: DataFrame) -> DataFrame:
    """Verdict per candidate (model, accuracy) against the earlier versions.

    The previous accuracy is that of the newest version marked ``prod``, else
    of the newest version, else the default. A candidate fails if its
    accuracy is not above the gate; ``beats_previous`` says whether it is
    also better than the previous one.
    """
    recency = F.struct(F.coalesce("prod", F.lit(False)), "version_id")
    previous = versions.groupBy(model.alias("model")).agg(F.max_by(accuracy, recency).alias("previous_accuracy"))
    judged = candidates.join(previous, "model", "left")
    judged = judged.withColumn("previous_accuracy", F.coalesce("previous_accuracy", F.lit(DEFAULT_ACCURACY)))
    return judged.withColumn("passed", F.col("accuracy") > F.lit(GATE)).withColumn(
        "beats_previous", F.col("accuracy") > F.col("previous_accuracy")
    )


class MetricsLog:
    """Metrics per model version, appended to a table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(
        self, model: str, version_id: int, metrics: Mapping[str, float], fingerprint: str, prod: bool = False
    ) -> None:
        rows = [(model, version_id, name, float(v), fingerprint, prod) for name, v in metrics.items()]
        self.append(local_table(self.spark, rows, METRICS_SCHEMA).coalesce(1))

    def append(self, rows: DataFrame) -> None:
        names = [f.split()[0] for f in METRICS_SCHEMA.split(", ")]
        rows.select(*names).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(METRICS_SCHEMA).parquet(self.path)

    def versions(self, metric: str = "accuracy") -> DataFrame:
        """One row per version with the value of one metric."""
        return self.read().where(F.col("metric") == metric).withColumnRenamed("value", metric)
