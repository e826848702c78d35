"""Row filters of the extract, backfill and check jobs.

Range bounds are compared with the raw column whenever it is a time already, so that the range
reaches the scan; text columns are parsed first.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casting import time_text
from ..functions.clock import epoch_if_null, naive_utc, ntz
from .columns import column_types

_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def time_of(df: DataFrame, name: str) -> Column:
    """The column as a time, parsed only if its type is not one."""
    kind = column_types(df)[name.lower()]
    col = F.col(f"`{name}`")
    return col if isinstance(kind, _TIMES) else time_text(col.cast("string"), T.TimestampNTZType())


def in_range(df: DataFrame, name: str, low: datetime | str | None, high: datetime | str | None) -> DataFrame:
    """Half-open ``[low, high)``; either bound may be open."""
    moment = time_of(df, name)
    if low is not None:
        df = df.filter(moment >= ntz(low))
    if high is not None:
        df = df.filter(moment < ntz(high))
    return df


def look_back(df: DataFrame, name: str, as_of: datetime | None = None,
              back: timedelta = timedelta(hours=2, minutes=30)) -> DataFrame:
    """Rows changed in the last 2 h 30 min before ``as_of``; runs overlap on purpose."""
    high = naive_utc(as_of or datetime.now(timezone.utc))
    return in_range(df, name, high - back, high)


def recent_days(df: DataFrame, name: str, as_of: date | None = None, days: int = 30) -> DataFrame:
    """Rows updated after midnight ``days`` days ago; a missing time counts as 1970."""
    today = as_of or datetime.now(timezone.utc).date()
    if isinstance(today, datetime):
        today = naive_utc(today).date()
    floor = datetime(today.year, today.month, today.day) - timedelta(days=days)
    moment = time_of(df, name)
    # NULL reads as 1970, which the strict bound rejects anyway when the floor is later
    return df.filter(moment > ntz(floor)) if floor >= datetime(1970, 1, 1) else df.filter(epoch_if_null(moment) > ntz(floor))


def backfill_filter(
    df: DataFrame,
    *,
    updated_col: str | None = "updated_at",
    filter_col: str | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """Range filter if bounds are given, else the 30-day guard, else everything."""
    have = {name.lower() for name in df.columns}
    if start is not None or end is not None:
        name = filter_col or updated_col
        if not name or name.lower() not in have:
            warnings.warn(f"filter column {name!r} is not in the source; the range is ignored", stacklevel=2)
            return df
        return in_range(df, name, start, end)
    if updated_col and updated_col.lower() in have:
        return recent_days(df, updated_col, as_of)
    return df


def check_filter(df: DataFrame, name: str, low: datetime, high: datetime, predicate: str = "") -> DataFrame:
    """Check window plus an optional free predicate."""
    df = in_range(df, name, low, high)
    return df.filter(F.expr(f"({predicate})")) if predicate.strip() else df


def newer_than(source: Column, target: Column) -> Column:
    """Strictly newer; a missing time counts as 1970 on either side."""
    return epoch_if_null(source) > epoch_if_null(target)


def log_selection(
    df: DataFrame,
    *,
    jobs: Sequence[str] = (),
    systems: Sequence[str] = (),
    year: int | None = None,
    month: int | None = None,
    days: tuple[int, int] | None = None,
    source_like: str | None = None,
    path_like: str | None = None,
) -> DataFrame:
    """Partition and path predicates of the log reports; unset ones do not filter."""
    if systems:
        df = df.filter(F.col("system").isin(*systems))
    if jobs:
        df = df.filter(F.col("job").isin(*jobs))
    if year is not None:
        df = df.filter(F.col("year") == year)
    if month is not None:
        df = df.filter(F.col("month") == month)
    if days is not None:
        df = df.filter(F.col("day").between(*days))
    if path_like is not None:
        df = df.filter(F.col("src").like(path_like))
    if source_like is not None:
        df = df.filter(F.col("source").like(source_like))
    return df


def select_changes(df: DataFrame, tables: Sequence[str] = (), operations: Sequence[str] = ("c", "u", "d"),
                   table_col: str = "table", op_col: str = "__op") -> DataFrame:
    """Changes of the listed tables and operations."""
    if tables:
        df = df.filter(F.col(f"`{table_col}`").isin(*tables))
    return df.filter(F.col(f"`{op_col}`").isin(*operations))
