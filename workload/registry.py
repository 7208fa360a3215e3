"""Queries by key, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"query {key} is registered twice")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return add
