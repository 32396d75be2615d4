"""Composed query plans over the test tables, registered by name with their
DuckDB oracle SQL (see ``registry``)."""

from terroir.plans import business, events, lifecycles, quality, remaining, reviews, serving, signals, sinks  # noqa: F401  (registers queries)
from terroir.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
