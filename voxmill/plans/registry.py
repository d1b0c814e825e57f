"""Named queries over the test tables, each with the SQL its result is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query '{key}' is registered twice")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register
