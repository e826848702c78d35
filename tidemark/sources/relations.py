"""Source relations: tables, parameterised queries and database extracts."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.columns import normalize_names


def table_name(table: str, database: str | None = None, catalog: str | None = None) -> str:
    """Quoted name; a dotted ``table`` carries its own schema."""
    parts = table.split(".") if "." in table else [p for p in (database, table) if p]
    if catalog and len(parts) < 3:
        parts = [catalog, *parts]
    return ".".join(f"`{part.strip('`')}`" for part in parts)


def read_table(spark: SparkSession, table: str, database: str | None = None, catalog: str | None = None) -> DataFrame:
    return spark.table(table_name(table, database, catalog))


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """Column names in order; resolves the schema only, no row is read."""
    return spark.table(table).columns


def table_types(spark: SparkSession, table: str) -> dict[str, T.DataType]:
    return {f.name.lower(): f.dataType for f in spark.table(table).schema.fields}


def positional_params(params: str | Sequence[Any] | None) -> list[Any]:
    """A list, or the text of a JSON array."""
    if params is None or params == "":
        return []
    value = json.loads(params) if isinstance(params, str) else params
    if not isinstance(value, (list, tuple)):
        raise ValueError("query parameters must be a JSON array")
    return list(value)


def query(spark: SparkSession, sql: str, params: str | Sequence[Any] | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL with ``?`` parameters over tables and ``{name}`` frames; normalise the column names."""
    args = positional_params(params)
    return normalize_names(spark.sql(sql, args=args or None, **frames))


def read_jdbc(
    spark: SparkSession,
    url: str,
    sql: str,
    *,
    options: Mapping[str, str] | None = None,
    split_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Database extract. With a split column and bounds, ``partitions`` tasks read slices in parallel.

    Filters and column pruning reach the database; the extract never passes through the driver.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**dict(options or {}))
    if split_column is None:
        return normalize_names(reader.option("query", sql).load())
    if bounds is None or not partitions:
        raise ValueError("a split read needs bounds and a partition count")
    reader = (
        reader.option("dbtable", f"({sql}) AS extract")
        .option("partitionColumn", split_column)
        .option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1]))
        .option("numPartitions", str(partitions))
    )
    return normalize_names(reader.load())
