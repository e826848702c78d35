"""Scans of date folders that are not in ``name=value`` form, such as ``2024/01/31/07``.

Spark prunes only ``name=value`` folders. Here the asked time range is turned into the few glob
patterns that cover it exactly - whole years, months, days, then hours - so that folders outside
the range are never listed, and the folder numbers come back as integer columns.
"""

from __future__ import annotations

import calendar
from collections.abc import Sequence
from datetime import datetime, timedelta
from itertools import zip_longest
from urllib.parse import quote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR_COLUMNS = ("yyyy", "mm", "dd", "hh")
DAY_COLUMNS = ("year", "month", "day")


def _aligned(moment: datetime, levels: int) -> datetime:
    return moment.replace(minute=0, second=0, microsecond=0, **({"hour": 0} if levels == 3 else {}))


def folder_patterns(low: datetime, high: datetime, *, levels: int = 4, prefixes: Sequence[str] = ()) -> list[str]:
    """Patterns of ``yyyy/mm/dd[/hh]`` folders (``levels`` 4 or 3) that overlap ``[low, high)``.

    ``prefixes`` are fixed texts before the numbers, e.g. ``("yyyy=", "mm=", "dd=", "hh=")``.
    """
    if levels not in (3, 4):
        raise ValueError("levels must be 3 (days) or 4 (hours)")
    at, out = _aligned(low, levels), []
    while at < high:
        if at.month == at.day == 1 and at.hour == 0 and datetime(at.year + 1, 1, 1) <= high:
            depth, step = 1, timedelta(days=366 if calendar.isleap(at.year) else 365)
        elif at.day == 1 and at.hour == 0 and _next_month(at) <= high:
            depth, step = 2, _next_month(at) - at
        elif at.hour == 0 and (levels == 3 or at + timedelta(days=1) <= high):
            depth, step = 3, timedelta(days=1)
        else:
            depth, step = 4, timedelta(hours=1)
        text = [f"{at.year:04d}", f"{at.month:02d}", f"{at.day:02d}", f"{at.hour:02d}"]
        numbers = text[:depth] + ["*"] * (levels - depth)
        out.append("/".join(a + b for a, b in zip_longest(prefixes[:levels], numbers, fillvalue="")))
        at += step
    return out


def _next_month(at: datetime) -> datetime:
    return datetime(at.year + at.month // 12, at.month % 12 + 1, 1)


def _glob(base: str, patterns: Sequence[str]) -> str:
    # one alternation: folders that do not exist are skipped, none at all is an error
    return f"{base.rstrip('/')}/{{{','.join(patterns)}}}"


def _number(folder: Column) -> Column:
    return F.regexp_extract(folder, "([0-9]+)$", 1).try_cast("int")


def _folder_number(path: Column, position: int, levels: int) -> Column:
    # file path is .../<number>/<number>/.../<file>; position counts from the left
    return _number(F.try_element_at(F.split(path, "/"), F.lit(-(levels - position) - 1)))


def read_hours(
    spark: SparkSession,
    base: str,
    schema: T.StructType,
    low: datetime,
    high: datetime,
    *,
    merge_schema: bool = False,
    prefixes: Sequence[str] = (),
) -> DataFrame:
    """Parquet rows of the hour folders in ``[low, high)`` with ``yyyy, mm, dd, hh`` columns."""
    names = list(HOUR_COLUMNS)
    try:
        reader = spark.read if merge_schema else spark.read.schema(schema)
        rows = reader.option("mergeSchema", merge_schema).parquet(_glob(base, folder_patterns(low, high, prefixes=prefixes)))
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        rows = None
    if rows is None:
        return spark.createDataFrame([], T.StructType(
            [*schema.fields, *(T.StructField(n, T.IntegerType()) for n in names)]))
    path = F.col("_metadata.file_path")
    return rows.select("*", *(_folder_number(path, i, 4).alias(n) for i, n in enumerate(names)))


def read_run_logs(
    spark: SparkSession,
    base: str,
    systems: Sequence[str],
    job: str | Sequence[str],
    low: datetime,
    high: datetime,
    *,
    prefixes: Sequence[str] = (),
) -> DataFrame:
    """Text lines under ``base/system/job/yyyy/mm/dd/``, any depth below, one row per line.

    The job must be given: jobs are not listed. Columns ``system, job, year, month, day, src, line``.
    """
    jobs = [job] if isinstance(job, str) else list(job)
    if not jobs or not all(jobs):
        raise ValueError("a run-log scan needs the job name(s)")
    if not systems:
        raise ValueError("a run-log scan needs the system name(s)")
    days = folder_patterns(low, high, levels=3, prefixes=prefixes)
    roots = [f"{s}/{j}/{d}" for s in systems for j in jobs for d in days]
    schema = T.StructType([T.StructField("line", T.StringType())])
    try:
        lines = spark.read.option("recursiveFileLookup", True).schema(schema).text(_glob(base, roots))
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame(
            [], "system string, job string, year int, month int, day int, src string, line string")
    src = F.col("_metadata.file_path")
    root = quote(urlsplit(base).path.rstrip("/") + "/", safe="/%:=+@,()!~'-_.")
    below = F.split(F.substring_index(src, root, -1), "/")
    part = [F.try_element_at(below, F.lit(i)) for i in range(1, 6)]
    return lines.select(
        F.url_decode(part[0]).alias("system"), F.url_decode(part[1]).alias("job"),
        *(_number(part[i + 2]).alias(name) for i, name in enumerate(DAY_COLUMNS)),
        src.alias("src"), "line",
    )


def with_source_file(df: DataFrame, name: str = "src") -> DataFrame:
    """Add the path of the file each row came from."""
    return df.select("*", F.col("_metadata.file_path").alias(name))
