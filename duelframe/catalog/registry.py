"""Named queries over the driver tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.adapters import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, needs: list[str] | None = None):
    """Register a query; ``needs`` lists the views its check uses."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = with_views(needs or [], sql)
        return fn
    return add


def stamp(column: str) -> str:
    """SQL text form of a timestamp, equal to :func:`stamp_col`."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
