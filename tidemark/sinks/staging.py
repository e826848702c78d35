"""All-text staging tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casting import all_text
from ..functions.clock import utc_clock

LOAD_DATE = "load_date"
MODES = ("overwrite_partitions", "append", "overwrite")


def staging_frame(
    df: DataFrame,
    *,
    partitions: Sequence[str] = (),
    types: Mapping[str, T.DataType | str] | None = None,
    as_of: datetime | None = None,
    force_text: bool = True,
) -> DataFrame:
    """Columns as text (but for ``types``), plus the UTC load date when it is a partition."""
    staged = all_text(df, types) if force_text else df.withColumns(
        {name: F.col(f"`{name}`").cast(kind) for name, kind in (types or {}).items()})
    if LOAD_DATE in partitions and LOAD_DATE not in df.columns:
        staged = staged.withColumn(LOAD_DATE, F.date_format(utc_clock(as_of), "yyyy-MM-dd"))
    return staged


def write_staging(
    df: DataFrame,
    path: str,
    *,
    table: str | None = None,
    partitions: Sequence[str] = (),
    mode: str = "overwrite_partitions",
    types: Mapping[str, T.DataType | str] | None = None,
    as_of: datetime | None = None,
    force_text: bool = True,
    schema_evolution: bool = True,
) -> None:
    """Write Parquet at ``path`` and, if ``table`` is given, register it there.

    ``overwrite_partitions`` replaces only the partitions the frame has rows for (the whole path
    when unpartitioned); ``append`` adds; ``overwrite`` replaces everything. A table is written through the catalog, which
    learns of the written partitions alone, without listing the others. With ``schema_evolution`` a load may bring
    new columns and wider types: the entry grows, columns that the load lacks are null. Otherwise, and for types
    of which neither holds the other, a different schema fails before anything is written, unless everything is replaced.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark, staged = df.sparkSession, staging_frame(df, partitions=partitions, types=types, as_of=as_of, force_text=force_text)
    fresh = mode == "overwrite" or (mode == "overwrite_partitions" and not partitions)
    if table:
        listed = register(spark, table, path, staged.schema, partitions, replace=fresh, schema_evolution=schema_evolution)
        have = {c.lower(): c for c in staged.columns}
        staged = staged.select(*(
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema.fields))
    writer = staged.write.mode("append" if mode == "append" else "overwrite")
    writer = writer.option("partitionOverwriteMode", "static" if fresh else "dynamic")
    if table:
        writer.insertInto(table)
        if not listed and partitions:  # the entry was made anew over partitions written before
            spark.sql(f"MSCK REPAIR TABLE {table}")
        spark.catalog.refreshTable(table)
    else:
        (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


#: Types of which each holds all values of those before it.
_WIDENING = ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType))


def wider_type(old: T.DataType, new: T.DataType) -> T.DataType:
    """The one of two types that holds the other's values; Parquet files of the narrower are read as it."""
    if old == new:
        return old
    for chain in _WIDENING:
        if type(old) in chain and type(new) in chain:
            return max(old, new, key=lambda kind: chain.index(type(kind)))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    raise ValueError(f"cannot widen {old.simpleString()} and {new.simpleString()} to one type")


def grown_schema(old: T.StructType, new: T.StructType, partitions: Sequence[str] = ()) -> T.StructType:
    """The old columns, widened where needed, then new ones; partition columns stay last. Names compare without case."""
    kinds = {f.name.lower(): f.dataType for f in new.fields}
    kept = [T.StructField(f.name, wider_type(f.dataType, kinds.get(f.name.lower(), f.dataType))) for f in old.fields]
    known = {f.name.lower() for f in old.fields}
    added = [T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() not in known]
    last = {p.lower() for p in partitions}
    return T.StructType([f for f in kept if f.name.lower() not in last] + added + [f for f in kept if f.name.lower() in last])


def register(spark: SparkSession, table: str, path: str, schema: T.StructType, partitions: Sequence[str] = (), *,
             replace: bool = False, schema_evolution: bool = True) -> bool:
    """Point an external table at ``path``; False when an entry was made anew that must list its partitions.

    New columns are added to an existing entry. Wider types, another path or another partitioning replace the entry (its files stay).
    """
    listed, last = True, {p.lower() for p in partitions}
    schema = T.StructType([f for f in schema.fields if f.name.lower() not in last] + [schema[p] for p in partitions])
    if spark.catalog.tableExists(table):
        old, columns = spark.table(table).schema, spark.catalog.listColumns(table)
        moved = (_plain_path(table_location(spark, table)) != _plain_path(path)
                 or {c.name.lower() for c in columns if c.isPartition} != last)
        if not moved and not replace:
            wanted = grown_schema(old, schema, partitions)
            if not schema_evolution and _plain_fields(wanted) != _plain_fields(old):
                raise ValueError(f"the load's schema differs from {table}: {schema.simpleString()}; allow schema_evolution or overwrite it")
            kinds = dict(_plain_fields(old))
            added = [f for f in wanted.fields if f.name not in kinds]
            if all(kinds.get(n, k) == k for n, k in _plain_fields(wanted)):
                if added:
                    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(added)})")
                return True
            schema, listed = wanted, False
        if moved or replace or not listed:
            if not replace or moved or _plain_fields(old) != _plain_fields(schema):
                spark.sql(f"DROP TABLE {table}")
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema.fields)}) USING parquet{by} LOCATION '{path}'")
    return listed


def _plain_fields(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in schema.fields]


def _columns(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _plain_path(path: str) -> str:
    """A location without the local scheme, as the catalog and the caller may write it differently."""
    return re.sub("^file:/+", "/", path).rstrip("/")


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    """Staging files; later files may have more columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def drop_staging(spark: SparkSession, table: str, *, purge: bool = False) -> str | None:
    """Drop the table entry; a failure comes back as text and is not raised.

    Files of an external table stay unless ``purge`` empties them first.
    """
    try:
        if purge and spark.catalog.tableExists(table):
            spark.sql(f"TRUNCATE TABLE {table}") if _managed(spark, table) else _empty(spark, table)
        spark.sql(f"DROP TABLE IF EXISTS {table}" + (" PURGE" if purge else ""))
    except Exception as problem:  # noqa: BLE001 - the merge is already done, dropping is housekeeping
        return str(problem)
    return None


def _managed(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "MANAGED"


def _empty(spark: SparkSession, table: str) -> None:
    """Replace an external staging table's files with none."""
    frame = spark.table(table)
    spark.createDataFrame([], frame.schema).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(table_location(spark, table))


def table_location(spark: SparkSession, table: str) -> str:
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    if row is None:
        raise ValueError(f"{table} has no location")
    return row["data_type"]
