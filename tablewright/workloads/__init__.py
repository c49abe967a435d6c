"""The operators applied to the test tables."""

from tablewright.workloads import (  # noqa: F401  (registering)
    aggregates,
    columns,
    feature_store,
    joins,
    models,
    monitoring,
    ordering,
    preparation,
    scans,
    serving,
    streams,
    versions,
)
from tablewright.workloads.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
