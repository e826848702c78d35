"""Run-log extraction and success reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import day_text
from ..functions.rules import json_number_field, json_text_field, rate_pct, run_succeeded, source_of_path
from ..schemas import RUN_STATUS

# Quoted fields of a run-status document.
STATUS_TEXT_FIELDS = (
    "run_id", "status", "host", "pg_schema", "staging_table", "prod_table", "started_at_utc",
    "ended_at_utc", "started_at_wib", "ended_at_wib", "timezone_wib", "log_s3_uri",
)
STATUS_PATH = "%/monitoring/status.json%"
FILE_COLUMNS = ("job", "year", "month", "day", "src")


def extract_runs(lines: DataFrame, *, path_like: str | None = STATUS_PATH) -> DataFrame:
    """One row per status file from its text lines (``job, year, month, day, src, line``).

    A file's fields may be spread over lines: each is the maximum over the file.

    Maxima of text are aggregated by sorting. Lines are therefore dealt out by file first, and a task sorts one
    shuffle partition, whose size adaptive execution bounds, instead of all the lines that it has read. The lines of
    one file meet in one task.
    """
    line = F.col("line")
    if path_like:
        lines = lines.filter(F.col("src").like(path_like))

    def text(name: str) -> Column:
        return F.max(json_text_field(line, name))

    def number(name: str) -> Column:
        return F.max(json_number_field(line, name)).try_cast("int")

    return (
        lines.repartition(*FILE_COLUMNS).groupBy(*FILE_COLUMNS)
        .agg(
            F.coalesce(text("pg_table"), text("prod_table"), text("staging_table")).alias("table_name"),
            text("job").alias("job_name_in_file"),
            number("exit_code").alias("exit_code"),
            number("duration_seconds").alias("duration_seconds"),
            *(text(name).alias(name) for name in STATUS_TEXT_FIELDS),
        )
        .withColumn("dt", day_text(F.col("year"), F.col("month"), F.col("day")))
        .withColumn("source_name", source_of_path(F.col("src")))
    )


def runs_from_documents(documents: DataFrame, column: str = "value") -> DataFrame:
    """Typed rows from whole JSON documents, one per row."""
    return documents.select(F.from_json(F.col(column), RUN_STATUS).alias("r")).select("r.*")


def _rates(total: Column, good: Column, bad: Column) -> list[Column]:
    rate = rate_pct(good, total)
    return [
        total.alias("total_jobs"), good.alias("success_count"), bad.alias("error_count"),
        F.round(F.lit(100) - rate, 2).alias("error_rate_pct"), rate.alias("success_rate_pct"),
    ]


def run_report(runs: DataFrame, *, days: tuple[str, str] | None = None, ordered: bool = False) -> DataFrame:
    """Success rates per day, source and table.

    A run of unknown outcome counts neither as success nor as error, but the error rate is
    100 minus the success rate and so covers it.
    """
    if days:
        runs = runs.filter(F.col("dt").between(*days))
    good = run_succeeded(F.col("status"), F.col("exit_code"))
    report = runs.groupBy("dt", F.col("source_name").alias("source"), "table_name").agg(
        *_rates(F.count(F.lit(1)), F.count_if(good), F.count_if(~good)))
    return report.orderBy("table_name") if ordered else report


def dq_run_report(log: DataFrame, *, dt: str | None = None, source_like: str | None = None) -> DataFrame:
    """The same report over the quality-run log."""
    if dt is not None:
        log = log.filter(F.col("dt") == dt)
    if source_like is not None:
        log = log.filter(F.col("source").like(source_like))
    status = F.col("JOB_STATUS")
    return log.groupBy("dt", "source", F.col("TABLE_NAME").alias("table_name")).agg(
        *_rates(F.count(F.lit(1)), F.count_if(status == "OK"), F.count_if(status == "ERR")))


def run_totals(log: DataFrame, by: Sequence[str] = ("dt", "hour", "source")) -> DataFrame:
    """Totals of each quality run: outcomes, summed durations, wall time."""
    start, end = F.col("RUN_START_ISO").try_cast("timestamp"), F.col("RUN_END_ISO").try_cast("timestamp")
    return log.groupBy(*by).agg(
        F.count_if(F.col("JOB_STATUS") == "OK").alias("tables_ok"),
        F.count_if(F.col("JOB_STATUS") == "ERR").alias("tables_err"),
        F.sum("TOTAL_DURATIONS").alias("sum_durations"),
        (F.unix_seconds(F.max(end)) - F.unix_seconds(F.min(start))).alias("wall_seconds"),
    )
