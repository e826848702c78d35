"""Silver tables: creation and the ways a merge result is published.

* a catalog with row-level operations takes the merge as ``MERGE INTO``;
* a partitioned Parquet table (its partitions are read from the catalog) is merged partition by
  partition: only partitions that the source's rows go to or come from are read; each gets a fresh folder and is
  switched to it in one step, and one left without rows is dropped from the catalog;
* a table in buckets of its keys is merged without shuffling it: only the source is dealt to the table's buckets, and
  what is written is in the same buckets again. It may be partitioned as well;
* otherwise a fresh folder is written and the table is switched to it in one step. Readers of
  the old folder are not disturbed, and a lost executor or a failed job leaves the table as it was.
  The whole table is rewritten, so large tables need partitions or a catalog with row-level operations.

A version is published only on top of the version its plan has read, a partition only on top of the files its plan has
read: when another writer was faster, :class:`TableMoved` is raised and :func:`merge_table` plans the merge again. The
catalog has no compare-and-set, so a moment remains between that comparison and the switch.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import column_types
from ..operators.upsert import MergeRules, merge_upsert, merge_into_catalog, prepare_source
from ..schemas import DQ_RESULT
from ..session import stable
from .staging import table_location

#: How often a merge is planned again after another writer's version.
ATTEMPTS = 5
#: Parquet with ZSTD level 3.
TABLE_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3"}


@dataclass(frozen=True)
class Buckets:
    """Rows of a table dealt to ``number`` files by the hash of ``columns``: for merges, all key columns."""

    columns: tuple[str, ...]
    number: int


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def assert_database(spark: SparkSession, name: str) -> None:
    if not spark.catalog.databaseExists(name):
        raise ValueError(f"database not found: {name!r}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str,
    *,
    partitions: Sequence[str] = (),
    using: str = "parquet",
    buckets: Buckets | None = None,
) -> None:
    """Empty table whose versions live under ``location``.

    With ``buckets`` its rows are dealt to that many files by the hash of the named columns and sorted by them within. A bucket is read
    and written by one task (in a partitioned table: one for all partitions of a merge), so choose their number for the size the table will have.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    if buckets:
        listed = ", ".join(f"`{c}`" for c in buckets.columns)
        by += f" CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets.number} BUCKETS"
    options = ", ".join(f"'{k}' = '{v}'" for k, v in TABLE_OPTIONS.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {using} OPTIONS ({options}){by} "
        f"LOCATION '{location.rstrip('/')}/version=0'"
    )


def create_dq_result_table(spark: SparkSession, table: str, location: str) -> None:
    create_table(spark, table, DQ_RESULT, location)


def create_view(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Session view over any frame, e.g. the raw log view or the latest-row view."""
    df.createOrReplaceTempView(name)


def create_latest_view(spark: SparkSession, name: str, table: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Catalog view of the newest row per key of a change table; it follows the table's later rows."""
    def listed(columns: Sequence[str], suffix: str = "") -> str:
        return ", ".join(f"`{c}`{suffix}" for c in columns)

    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {listed(spark.table(table).columns)} FROM (SELECT *, row_number() OVER ("
        f"PARTITION BY {listed(keys)} ORDER BY {listed(order, ' DESC NULLS LAST')}) AS `__latest_rank` FROM {table}) "
        "WHERE `__latest_rank` = 1"
    )


def _version_root(spark: SparkSession, table: str) -> str:
    return table_location(spark, table).rstrip("/").rsplit("/", 1)[0]


class TableMoved(RuntimeError):
    """Another writer published a version after this one was planned."""


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def bucket_layout(spark: SparkSession, table: str) -> Buckets | None:
    """The buckets the catalog names for the table."""
    columns = tuple(c.name for c in spark.catalog.listColumns(table) if c.isBucket)
    if not columns:
        return None
    number = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    return Buckets(columns, int(number["data_type"]))


def merged_in_buckets(rules: MergeRules, buckets: Buckets | None) -> MergeRules:
    """The rules for a table in ``buckets``: where these are of the merge keys, the full outer join, since it leaves the table where it is."""
    fits = buckets is not None and sorted(c.lower() for c in buckets.columns) == sorted(k.lower() for k in rules.keys)
    return replace(rules, strategy="full_outer") if fits and rules.dedupe and rules.strategy == "auto" else rules


def _write_in_buckets(spark: SparkSession, table: str, rows: DataFrame, path: str, buckets: Buckets, dealt: bool) -> None:
    """``rows`` as files of the table's layout below ``path``; ``dealt`` rows stand in its buckets already.

    Only a write through the catalog makes buckets, so the files are written as those of a table of the same layout, whose entry is dropped
    again. Spark leaves the files of a table with a location of its own where they are.
    """
    entry = f"{table.strip('`')}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {entry} LIKE {table} LOCATION {_sql_text(path)}")
    try:
        rows = rows.select(*spark.table(table).columns)
        (rows if dealt else rows.repartition(buckets.number, *buckets.columns)).write.insertInto(entry)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {entry}")


def _marks_path(spark: SparkSession, table: str, version: str) -> str:
    return f"{_version_root(spark, table)}/streams/version={version}"


def stream_marks(spark: SparkSession, table: str) -> dict[str, int]:
    """The last batch of every stream that the table's current version holds."""
    try:
        rows = spark.read.schema("stream string, batch long").json(_marks_path(spark, table, current_version(spark, table)))
        return {r["stream"]: r["batch"] for r in rows.collect()}  # one row a stream
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return {}


def publish_version(spark: SparkSession, table: str, df: DataFrame, version: str | None = None, *,
                    planned_on: str | None = None, marks: Mapping[str, int] | None = None, dealt: bool = False) -> str:
    """Write ``df`` as a new version of an unpartitioned table and switch the table to it.

    ``planned_on`` is the location the plan has read; the switch is refused when the table has moved
    on. ``marks`` are the stream marks of the new version (None: those of the version before): they
    lie beside the version's folder and become valid with the switch. A table in buckets gets its rows dealt to
    them, unless ``dealt`` says that each task of ``df`` has rows of few buckets as it is.
    """
    if partition_columns(spark, table):
        raise ValueError(f"{table} is partitioned: merge it by partitions, a new location would hide its rows")
    version = version or uuid.uuid4().hex
    path, kept = f"{_version_root(spark, table)}/version={version}", stream_marks(spark, table) if marks is None else marks
    buckets = bucket_layout(spark, table)
    if buckets:
        _write_in_buckets(spark, table, df, path, buckets, dealt)
    else:
        df.write.mode("overwrite").options(**TABLE_OPTIONS).parquet(path)
    if kept:
        spark.createDataFrame(sorted(kept.items()), "stream string, batch long").coalesce(1).write.mode("overwrite").json(
            _marks_path(spark, table, version))
    if planned_on is not None and table_location(spark, table) != planned_on:
        raise TableMoved(f"{table} is no longer at {planned_on}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return path


def current_version(spark: SparkSession, table: str) -> str:
    return table_location(spark, table).rstrip("/").rsplit("version=", 1)[-1]


def merge_whole(spark: SparkSession, table: str, source: DataFrame, rules: MergeRules, version: str | None = None,
                batch: tuple[str, int] | None = None) -> None:
    """Merge into an unpartitioned table by publishing a new version.

    ``batch`` names a stream and its batch number: one that the table already holds is skipped.
    """
    spark.catalog.refreshTable(table)
    planned_on, marks = table_location(spark, table), stream_marks(spark, table)
    if batch is not None:
        if marks.get(batch[0], -1) >= batch[1]:
            return
        marks = {**marks, batch[0]: batch[1]}
    rules = merged_in_buckets(rules, bucket_layout(spark, table))
    publish_version(spark, table, merge_upsert(spark.table(table), source, rules, run_once=stable), version, planned_on=planned_on, marks=marks,
                    dealt=rules.strategy == "full_outer" and rules.dedupe)


def touched_partitions(target: DataFrame, touched: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Target rows of the partitions whose values ``touched`` lists.

    The values are joined to the table's: Spark's dynamic partition pruning makes
    them a partition filter at run time, however many there are. They are broadcast: there are as
    many as partitions are merged at once, and each of those is a folder to be written anyway.
    """
    def text(df: DataFrame, name: str) -> Column:
        # nulls become a value, since only plain equality is pruned by
        return F.coalesce(df[name].cast("string"), F.lit("\u0000null"))

    wanted = touched.select(*partitions).distinct()
    # true for every row; as a filter it tells the optimizer that pruning pays
    wanted = wanted.filter(F.length(text(wanted, partitions[0])) >= 0)
    condition = [text(target, p) == text(wanted, p) for p in partitions]
    return target.join(F.broadcast(wanted), condition, "left_semi")


def rows_of_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], partitions: Sequence[str]) -> DataFrame:
    """Key and partition columns of the target rows whose keys lie between the source's smallest and largest.

    The bounds are literals, so Parquet statistics leave out the row groups, and mostly the files, that cannot hold a key.
    """
    ends = source.agg(*(f(k).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in (("low", F.min), ("high", F.max)))).first()
    known = target.select(*dict.fromkeys((*keys, *partitions)))
    for i, k in enumerate(keys):
        kind = target.schema[k].dataType
        # without any value the comparison is null, and no row is kept
        known = known.filter(F.col(k).between(F.lit(ends[f"low_{i}"]).cast(kind), F.lit(ends[f"high_{i}"]).cast(kind)))
    return known


def home_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], partitions: Sequence[str]) -> DataFrame:
    """Partition values under which the table holds any of the source's keys now."""
    known = rows_of_keys(target, source, keys, partitions)
    return known.join(source.select(*keys).distinct(), list(keys), "left_semi").select(*partitions).distinct()


def require_home_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], partitions: Sequence[str]) -> None:
    """Fail when a source key stands in the table under another partition value."""
    known = rows_of_keys(target, source, keys, partitions).select(*keys, *(F.col(f"`{p}`").alias(f"__at_{i}") for i, p in enumerate(partitions)))
    moved = F.lit(False)
    for i, p in enumerate(partitions):
        moved = moved | ~F.col(f"`{p}`").eqNullSafe(F.col(f"__at_{i}"))
    wrong = source.select(*dict.fromkeys((*keys, *partitions))).distinct().join(known, list(keys)).filter(moved)
    found = wrong.select(*keys).take(3)
    if found:
        raise ValueError(f"keys stored in another partition than the source says: {[tuple(r) for r in found]}")


def _files(rows: DataFrame, touched: DataFrame | None, partitions: Sequence[str]) -> dict[tuple, tuple]:
    """Partition values as text -> first and last file and row count. Reads file footers; one row a partition reaches the driver."""
    listed = rows.select(*partitions, F.col("_metadata.file_path").alias("__file"))
    if touched is not None:
        listed = touched_partitions(listed, touched, partitions)
    found = listed.groupBy(*partitions).agg(F.min("__file").alias("__first"), F.max("__file").alias("__last"), F.count("*").alias("__rows"))
    texts = found.select(*(F.col(p).cast("string") for p in partitions), "__first", "__last", "__rows").collect()
    return {tuple(r[:-3]): tuple(r[-3:]) for r in texts}


def _sql_text(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _switch_partitions(spark: SparkSession, table: str, path: str, partitions: Sequence[str], touched: DataFrame,
                       planned_on: dict[tuple, tuple]) -> None:
    """Point the touched partitions at what was written below ``path``, and drop those of which nothing was written.

    Each partition changes in one step and its old files stay, so a reader sees it as it was or as it is. Partitions change one after the
    other, dropped ones last: for a moment a key that moves may be seen in both places, never in none.
    """
    written = _files(spark.read.schema(spark.table(table).schema).parquet(path), None, partitions)
    spark.catalog.refreshTable(table)
    if _files(spark.table(table), touched, partitions) != planned_on:
        raise TableMoved(f"partitions of {table} have changed since they were read")

    def spec(values: tuple) -> str:
        return "PARTITION (" + ", ".join(f"`{p}` = {_sql_text(v)}" for p, v in zip(partitions, values, strict=True)) + ")"

    def folder(values: tuple) -> str:
        return _sql_text(unquote(written[values][0]).rsplit("/", 1)[0])

    fresh = [v for v in written if v not in planned_on]
    if fresh:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"{spec(v)} LOCATION {folder(v)}" for v in fresh))
    for values in written:
        if values in planned_on:
            spark.sql(f"ALTER TABLE {table} {spec(values)} SET LOCATION {folder(values)}")
    emptied = [v for v in planned_on if v not in written]
    if emptied:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(map(spec, emptied)))
    spark.catalog.refreshTable(table)


#: What a merge does about source keys that the table holds in another partition.
MOVED = ("merge", "error", "never")


def merge_partitions(spark: SparkSession, table: str, source: DataFrame, rules: MergeRules,
                     partitions: Sequence[str] | None = None, *, moved: str = "merge") -> None:
    """Merge into a partitioned table, replacing only the partitions the source touches.

    The source must carry the partition columns (deletes need their keys alone). With ``moved="merge"`` the partitions that hold the source's
    keys now are merged along, so a key whose partition value changes leaves its old partition in the same merge; ``"error"`` fails on such a
    key; ``"never"`` does not look for them, where the partition is computed from the key. The look-up reads the key columns of the row
    groups that can hold a source key. A partition that loses its last row is dropped.

    The source is checkpointed first, so that all steps see the same rows. Raises :class:`TableMoved`, with nothing changed, when the files
    of a touched partition are not those the plan has read.
    """
    if moved not in MOVED:
        raise ValueError(f"moved must be one of {MOVED}")
    spark.catalog.refreshTable(table)
    target = spark.table(table)
    partitions = list(partitions or partition_columns(spark, table))
    source = stable(source)
    versions = prepare_source(source, column_types(target), replace(rules, dedupe=False))
    touched = versions.select(*partitions).distinct()
    if not set(partitions) <= set(rules.keys):
        if moved == "error":
            require_home_partitions(target, versions, rules.keys, partitions)
        elif moved == "merge":
            touched = touched.unionByName(home_partitions(target, versions, rules.keys, partitions)).distinct()
    touched = stable(touched)
    if touched.isEmpty():
        return
    planned_on = _files(target, touched, partitions)
    buckets = bucket_layout(spark, table)
    rules = merged_in_buckets(rules, buckets)
    merged = merge_upsert(touched_partitions(target, touched, partitions), source, rules, run_once=stable)
    path = f"{_version_root(spark, table)}/merge={uuid.uuid4().hex}"
    if buckets:
        _write_in_buckets(spark, table, merged, path, buckets, rules.strategy == "full_outer" and rules.dedupe)
    else:
        # rebalance groups rows by partition, splits a partition that holds most of them over several
        # writers and joins small ones
        merged.select(*target.columns).hint("rebalance", *partitions).write.options(**TABLE_OPTIONS).partitionBy(*partitions).parquet(path)
    _switch_partitions(spark, table, path, partitions, touched, planned_on)


def supports_row_merge(spark: SparkSession, table: str) -> bool:
    """True for catalog tables that accept MERGE (none is on the class path of the tests)."""
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Provider'").first()
    return bool(row) and row["data_type"].lower() in ("iceberg", "delta")


def merge_table(spark: SparkSession, table: str, source: DataFrame, rules: MergeRules,
                partitions: Sequence[str] = (), version: str | None = None, *,
                batch: tuple[str, int] | None = None) -> None:
    """Merge ``source`` into ``table`` by the way its storage allows.

    The catalog says whether the table is partitioned; ``partitions``, when given, must agree.
    """
    if supports_row_merge(spark, table):
        merge_into_catalog(spark, table, source, rules)
        return
    stored = partition_columns(spark, table)
    if partitions and set(partitions) != set(stored):
        raise ValueError(f"{table} is partitioned by {stored}, not by {list(partitions)}")
    for attempt in range(ATTEMPTS):
        try:
            if stored:
                merge_partitions(spark, table, source, rules, stored)
            else:  # a second attempt needs a folder of its own
                merge_whole(spark, table, source, rules, version if attempt == 0 else None, batch)
            return
        except TableMoved:
            if attempt == ATTEMPTS - 1:
                raise
