"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if given, the SQL that computes the same rows independently."""

    def register(func: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = func
        if sql is not None:
            ORACLES[name] = sql
        return func

    return register
