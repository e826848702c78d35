"""Plan-time choices: alignment modes, default filter columns, windows, order columns, default casts."""

from __future__ import annotations

import warnings
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casting import cast_column
from tidemark.functions.clock import resolve_window
from tidemark.operators.columns import align_columns
from tidemark.operators.latest import dedupe_source
from tidemark.operators.predicates import backfill_filter, in_range
from tidemark.operators.reconcile import CheckSpec, reconcile_many
from tidemark.session import scratch_path
from tidemark.sources.partitioned import read_run_logs

from .checking import BROKEN, HIGH, LOW
from .inputs import DB_SOURCE, padded, plain, run_log_lines, silver_events, spread, table, with_inputs
from .registry import query

_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus"]


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def align_compat_positions(spark, sf):
    """As many columns as the source's DDL has: they take its names in order."""
    return align_columns(table(spark, sf, "orders").select(*_ORDER).toDF("a", "b", "c"), _ORDER, ["other"], by="compat")


@query("SELECT o_orderkey, o_custkey FROM orders")
def align_head_positions(spark, sf):
    """Fewer columns than names: they take the first names."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return align_columns(table(spark, sf, "orders").select(*_ORDER[:2]).toDF("a", "b"), (), _ORDER, by="position")


@query("SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'")
def backfill_default_column(spark, sf):
    """A range without a filter column goes by the update column."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return backfill_filter(events, updated_col="ts", start=datetime(2024, 1, 5), end=datetime(2024, 1, 20))


@query("SELECT event_id, ts, event_type FROM events")
def backfill_unknown_column(spark, sf):
    """A filter column that the source lacks warns and filters nothing."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return backfill_filter(events, updated_col="ts", filter_col="no_such_column", start=datetime(2024, 1, 5))


@query("""SELECT event_id, ts FROM events WHERE (ts >= TIMESTAMP '2024-01-07' AND ts < TIMESTAMP '2024-01-08')
  OR (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12') OR (ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21')
  OR (ts >= TIMESTAMP '2024-01-25' AND ts < TIMESTAMP '2024-01-26')""")
def window_choices(spark, sf):
    """Start alone, start and end, a target date, and today."""
    windows = [resolve_window(date(2024, 1, 7)), resolve_window(date(2024, 1, 10), date(2024, 1, 12)),
               resolve_window(target_date=date(2024, 1, 20)), resolve_window(today=date(2024, 1, 25))]
    events, out = table(spark, sf, "events").select("event_id", "ts"), None
    for low, high in windows:
        part = in_range(events, "ts", low, high)
        out = part if out is None else out.unionAll(part)
    return out


@query(with_inputs("""SELECT 'good' AS outcome, count(*) AS total_row_silver FROM silver_events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'
UNION ALL SELECT 'failed ' || v, count(*) FROM (VALUES ('broken'), ('broken later')) f(v), events GROUP BY v
UNION ALL SELECT 'alone', 0""", "silver_events"))
def reconcile_none_succeeded(spark, sf):
    """Broken checks beside a good one, which keeps its rows, and alone, which leaves an empty result of the same columns."""
    def checks(*specs):
        return reconcile_many(spark, specs, lambda schema, name: table(spark, sf, name), lambda db, name: silver_events(spark, sf),
                              LOW, HIGH, database_source=DB_SOURCE)

    good = CheckSpec("good", "public", "events", "silver", "events", "ts", "ts")
    mixed, alone = checks(BROKEN, good, replace(BROKEN, id="broken later")), checks(BROKEN)
    if mixed.results.dtypes != alone.results.dtypes:
        raise AssertionError("columns differ without a successful check")
    rows = F.sum("total_row_silver").alias("total_row_silver")
    failed = mixed.failures.join(table(spark, sf, "events").agg(F.count("*").alias("total_row_silver")))  # one row
    return (mixed.results.agg(rows).select(F.lit("good").alias("outcome"), "total_row_silver")
            .unionAll(failed.select(F.concat(F.lit("failed "), "check_id"), "total_row_silver"))
            .unionAll(alone.results.agg(F.count("*")).select(F.lit("alone"), "count(1)")))


@query("SELECT event_id, event_type AS same, hex(event_type) AS bytes FROM events")
def cast_default(spark, sf):
    """A column without a target type passes through; a type without a rule of its own is cast."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select("event_id", cast_column(kind, None).alias("same"), F.hex(cast_column(kind, T.BinaryType())).alias("bytes"))


def _latest_sql(order: str) -> str:
    return f"SELECT user_id, event_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {order}) = 1"


def _latest(spark, sf, **order):
    return dedupe_source(table(spark, sf, "events").select("user_id", "event_id", "ts", "value"), "user_id", **order)


@query(_latest_sql("ts DESC, event_id DESC"))
def dedupe_updated_only(spark, sf):
    return _latest(spark, sf, updated_col="ts", created_col=None, tiebreakers=["event_id"])


@query(_latest_sql("ts DESC, event_id DESC"))
def dedupe_created_only(spark, sf):
    """The update column is missing: the creation time orders."""
    return _latest(spark, sf, updated_col="updated_at", created_col="ts", tiebreakers=["event_id"])


@query(_latest_sql("value DESC, event_id DESC"))
def dedupe_without_times(spark, sf):
    return _latest(spark, sf, updated_col=None, created_col=None, tiebreakers=["value", "event_id"])


@query(with_inputs("""SELECT DISTINCT system, job, concat('system=', system, '/job=', job, '/year=2024/month=', lpad(CAST(month AS VARCHAR), 2, '0'),
  '/day=', lpad(CAST(day AS VARCHAR), 2, '0')) AS folder, day FROM run_log_lines
WHERE year = 2024 AND month = 1 AND day BETWEEN 3 AND 20 AND system = 'db0' AND job = 'click'""", "run_log_lines"))
def log_source_files(spark, sf):
    """The source file of each line names the folder it lies in."""
    path = scratch_path(spark, "logs") + "/logs/cron-batch"
    parts = ["system", "job", "year", "month", "day"]
    lines = run_log_lines(spark, sf).select("line", "system", "job", F.col("year").cast("string").alias("year"),
                                            padded(F.col("month")).alias("month"), padded(F.col("day")).alias("day"))
    spread(lines, *parts).write.partitionBy(*parts).text(path)
    found = read_run_logs(spark, path, ["system=db0"], ["job=click"], datetime(2024, 1, 3), datetime(2024, 1, 21), prefixes=("year=", "month=", "day="))
    folder = F.regexp_extract(F.url_decode(F.substring_index("src", "/cron-batch/", -1)), "^(.*)/[^/]+$", 1)
    value = lambda name: F.substring_index(name, "=", -1)
    return plain(found.select(value("system").alias("system"), value("job").alias("job"), folder.alias("folder"), "day").distinct())
