"""Operators for large text corpora, each applied to the test tables as a query."""

from tablewright.llm import queries  # noqa: F401  (registering)
from tablewright.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
