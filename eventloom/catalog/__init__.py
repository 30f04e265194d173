"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.catalog import assigning, bursting, counting, evolving, joining, measuring, ordering

Query = Callable[[SparkSession, str], DataFrame]

_PARTS = (counting, joining, bursting, measuring, evolving, ordering, assigning)


def all_queries() -> dict[str, Query]:
    """Query functions by name."""
    return {name: run for part in _PARTS for name, run in part.QUERIES.items()}


def all_sql() -> dict[str, str]:
    """SQL by query name, for the queries that can be checked by SQL."""
    return {name: sql for part in _PARTS for name, sql in part.SQL.items()}
