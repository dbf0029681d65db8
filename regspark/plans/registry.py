"""All registered queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        _queries[name] = fn
        if sql:
            _sql[name] = sql
        return fn

    return add


def load() -> None:
    from . import queries  # noqa: F401


def queries() -> dict[str, Query]:
    load()
    return _queries


def oracle_sql() -> dict[str, str]:
    load()
    return _sql
