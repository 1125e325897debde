"""Where queries and the SQL that checks them are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own or the given name, with the DuckDB SQL that must give the same rows."""

    def add(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql
        return query

    return add
