"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL if there is one."""

    def register(func: Query) -> Query:
        QUERIES[name] = func
        if sql is not None:
            ORACLES[name] = sql
        return func

    return register
