"""Time helpers. Every clock is an argument; ``None`` means the query's current time."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

WIB = "Asia/Jakarta"
EPOCH = datetime(1970, 1, 1)


def naive_utc(moment: datetime) -> datetime:
    """Zone-aware times become zone-less UTC; zone-less ones are taken as UTC."""
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def ntz(moment: datetime | date | str) -> Column:
    """A zone-less timestamp literal (folded at plan time, so it still reaches the scan)."""
    if isinstance(moment, datetime):
        moment = naive_utc(moment)
    return F.lit(str(moment)).cast("timestamp_ntz")


def utc_clock(as_of: datetime | None = None) -> Column:
    if as_of is not None:
        return ntz(as_of)
    return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))


def to_wib(col: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(WIB), col)


def wib_clock(as_of: datetime | None = None) -> Column:
    """Jakarta wall clock, whole milliseconds."""
    return trunc("millisecond", to_wib(utc_clock(as_of)))


def trunc(unit: str, col: Column) -> Column:
    """``date_trunc`` that stays zone-less."""
    return F.date_trunc(unit, col).cast("timestamp_ntz")


def epoch_if_null(col: Column) -> Column:
    return F.coalesce(col, ntz(EPOCH))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", start, end)


def hour_text(col: Column) -> Column:
    """``HH:00:00`` of a time."""
    return F.date_format(col, "HH:00:00")


def slot_text(col: Column) -> Column:
    """``yyyy-MM-dd HH:00:00`` of a time."""
    return F.date_format(col, "yyyy-MM-dd HH:00:00")


def day_text(year: Column, month: Column, day: Column) -> Column:
    return F.format_string("%04d-%02d-%02d", year, month, day)


def resolve_window(
    start: date | datetime | None = None,
    end: date | datetime | None = None,
    target_date: date | None = None,
    today: date | None = None,
) -> tuple[datetime, datetime]:
    """Half-open check window.

    Start and end as given; start alone covers one day; else the target date; else today (UTC).
    """
    def midnight(value: date | datetime) -> datetime:
        return naive_utc(value) if isinstance(value, datetime) else datetime(value.year, value.month, value.day)

    if start is not None and end is not None:
        low, high = midnight(start), midnight(end)
        if high <= low:
            raise ValueError(f"window end {high} must be later than its start {low}")
        return low, high
    if end is not None:
        raise ValueError("a window end needs a start")
    low = midnight(start or target_date or today or datetime.now(timezone.utc).date())
    return low, low + timedelta(days=1)
