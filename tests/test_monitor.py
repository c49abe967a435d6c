"""Drift, the t distribution, the gate and the log."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.functions.stats import regularised_beta, t_two_sided
from tablewright.operators import monitor
from tablewright.sources.workspace import new_dir
from tests.conftest import rows


@pytest.mark.parametrize(
    "t, dof, p",
    [
        (0.0, 5.0, 1.0),
        (1.0, 1.0, 0.5),  # closed form: 1 - 2 atan(t) / pi
        (2.0, 1.0, 1 - 2 * math.atan(2.0) / math.pi),
        (3.0, 2.0, 1 - 3.0 / math.sqrt(11.0)),  # closed form: 1 - t / sqrt(t^2 + 2)
        (-3.0, 2.0, 1 - 3.0 / math.sqrt(11.0)),
        (2.2281388519649385, 10.0, 0.05),  # table values
        (1.9599639845400545, 1e9, 0.05),
        (2.5758293035489004, 1e9, 0.01),
    ],
)
def test_t_distribution(t, dof, p):
    assert math.isclose(t_two_sided(t, dof), p, rel_tol=1e-6, abs_tol=1e-9)


def test_beta_symmetry():
    for a, b, x in [(0.5, 2.0, 0.3), (7.0, 0.5, 0.9), (100.0, 0.5, 0.999)]:
        assert math.isclose(regularised_beta(a, b, x) + regularised_beta(b, a, 1 - x), 1.0, rel_tol=1e-12)


def test_mean_shift(spark):
    rng = random.Random(6)
    ref = [(rng.gauss(0, 1), rng.gauss(5, 2), 1.0, 1.0) for _ in range(400)]
    live = [(rng.gauss(0, 1), rng.gauss(7, 3), 1.0, 2.0) for _ in range(100)]
    data = [("TRAINING", *r) for r in ref] + [("LIVE", *r) for r in live]
    df = spark.createDataFrame(data, "tag string, same double, moved double, fixed double, jumped double").repartition(3)
    out = monitor.with_p_value(monitor.mean_shift(df, "tag", ["same", "moved", "fixed", "jumped"]))
    got = {r["column_name"]: r for r in out.collect()}
    a, b = np.array(ref)[:, 1], np.array(live)[:, 1]
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    assert math.isclose(got["moved"]["t"], (b.mean() - a.mean()) / math.sqrt(va + vb), rel_tol=1e-9)
    assert math.isclose(
        got["moved"]["dof"], (va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1)), rel_tol=1e-9
    )
    assert got["moved"]["drifted"] and not got["same"]["drifted"]
    assert got["fixed"]["p_value"] == 1.0 and got["jumped"]["p_value"] == 0.0


def test_mean_shift_without_live_rows(spark):
    df = spark.createDataFrame([("TRAINING", 1.0), ("TRAINING", 2.0)], "tag string, v double")
    row = monitor.with_p_value(monitor.mean_shift(df, "tag", ["v"])).first()
    assert row["t"] is None and row["p_value"] is None


def test_gate_and_log(spark):
    log = monitor.MetricsLog(spark, new_dir(spark, "metrics"))
    log.record("m", 1, {"accuracy": 0.5}, "f1", prod=True)
    log.record("m", 2, {"accuracy": 0.2, "rows": 10}, "f2")
    log.record("n", 1, {"accuracy": 0.3}, "f3")
    assert rows(log.versions().select("model", "version_id", "accuracy")) == [("m", 1, 0.5), ("m", 2, 0.2), ("n", 1, 0.3)]
    candidates = spark.createDataFrame([("m", 0.4), ("n", 0.31), ("new", 0.01)], "model string, accuracy double")
    out = monitor.quality_gate(log.versions(), F.col("model"), F.col("accuracy"), candidates)
    got = {r["model"]: (r["previous_accuracy"], r["passed"], r["beats_previous"]) for r in out.collect()}
    assert got == {"m": (0.5, True, False), "n": (0.3, True, True), "new": (0.1, False, False)}
