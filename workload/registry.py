"""Query registry shared by the workload modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its DuckDB twin if it has one."""
    def keep(function: Query) -> Query:
        key = name or function.__name__

        def run(spark: SparkSession, sf: str) -> DataFrame:
            return function(configure(spark), sf)

        run.__name__, run.__doc__ = key, function.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return function

    return keep
