"""Small business rules shared by checks, log reports and KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_gap(silver: Column, source: Column) -> Column:
    return F.abs(silver - source)


def gap_status(silver: Column, source: Column) -> Column:
    return F.when(silver == source, F.lit("SAME")).otherwise(F.lit("DIFF"))


def larger_side(silver: Column, source: Column) -> Column:
    return F.when(silver > source, F.lit("silver")).when(silver < source, F.lit("source")).otherwise(F.lit("same"))


def check_id(day: Column, *parts: str | Column) -> Column:
    """md5 of the bar-joined parts and the day."""
    texts = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", *texts, F.date_format(day, "yyyy-MM-dd")))


def json_text_field(line: Column, name: str) -> Column:
    """Value of a quoted JSON field in a text line, NULL when absent.

    The plain substring test spares the regex on lines that cannot match.
    """
    hit = F.regexp_extract(line, rf'"{name}"\s*:\s*"([^"]+)"', 1)
    return F.when(line.contains(f'"{name}"'), F.nullif(hit, F.lit("")))


def json_number_field(line: Column, name: str) -> Column:
    hit = F.regexp_extract(line, rf'"{name}"\s*:\s*([0-9]+)', 1)
    return F.when(line.contains(f'"{name}"'), F.nullif(hit, F.lit("")))


def source_of_path(path: Column, root: str = "/logs/cron-batch/") -> Column:
    """The folder right under the log root."""
    return F.nullif(F.regexp_extract(path, rf"{root}([^/]+)/", 1), F.lit(""))


def run_succeeded(status: Column, exit_code: Column, words: Sequence[str] = ("success", "ok")) -> Column:
    """NULL when the status or exit code is unknown and the other part does not settle it."""
    return F.lower(status).isin(*words) & (exit_code == 0)


def rate_pct(part: Column, whole: Column) -> Column:
    """Percentage, two decimals, NULL for an empty whole."""
    return F.round(part * F.lit(100.0).cast("double") / F.nullif(whole, F.lit(0)), 2)
