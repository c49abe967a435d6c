"""Which items were most popular in a period."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.aggs import group_mean
from tablewright.operators.columns import in_time_range


def top_items(
    rankings: DataFrame, properties: DataFrame, on: str, name: str, ts: str, popularity: str, start: datetime,
    end: datetime, k: int = 10,
) -> DataFrame:
    """The ``k`` names with the highest mean popularity in ``[start, end)``.

    The period is filtered before the join, where the scan can use it.
    """
    period = in_time_range(rankings.select(on, ts, popularity), ts, start, end)
    joined = period.join(properties.select(on, name), on, "inner").dropna("any")
    means = group_mean(joined, [name], [popularity])
    return means.orderBy(F.desc(popularity), name).limit(k)
