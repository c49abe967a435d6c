"""Student's t distribution for a handful of test results."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def regularised_beta(a: float, b: float, x: float) -> float:
    """I_x(a, b) by its continued fraction (modified Lentz evaluation)."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - regularised_beta(b, a, 1.0 - x)
    tiny = 1e-300
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        change = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            change = c * d
            total *= change
        if abs(change - 1.0) < 1e-15:
            break
    return front * total


def t_two_sided(t: float, dof: float) -> float:
    """Probability of a |t| at least this large under equal means."""
    return regularised_beta(dof / 2.0, 0.5, dof / (dof + t * t))


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, dof: pd.Series) -> pd.Series:
    """``t_two_sided`` over result rows (one per tested column)."""
    return pd.Series(
        [None if pd.isna(a) or pd.isna(b) else t_two_sided(a, b) for a, b in zip(t, dof)], dtype="float64"
    )
