"""Hourly reconciliation, run-log and KPI queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import trunc
from tidemark.functions.rules import rate_pct
from tidemark.operators import kpi
from tidemark.operators.predicates import log_selection
from tidemark.operators.reconcile import (
    SILVER_ROWS, SLOT, SOURCE_ROWS, CheckSpec, compare_counts, covered_hours, fill_hours, hour_grid, hourly_counts,
    reconcile_check, reconcile_many, upsert_results,
)
from tidemark.operators.runlog import dq_run_report as dq_report
from tidemark.operators.runlog import extract_runs, run_report, runs_from_documents
from tidemark.operators.runlog import run_totals as totals
from tidemark.session import scratch_path, stable

from .inputs import (
    AS_OF, AS_OF_WIB_SQL, DB_SOURCE, WINDOW, dq_run_log, job_sla, order_runs, plain, run_log_lines, runs, silver_events, table,
    with_inputs,
)
from .registry import query

LOW, HIGH = WINDOW
SPEC = CheckSpec("events", "public", "events", "silver", "events", "ts", "ts")
HALF = datetime(2024, 1, 16)
AS_OF_LATER = datetime(2024, 2, 2, 3, 30, 15, 250000)
AS_OF_LATER_WIB_SQL = "TIMESTAMP '2024-02-02 10:30:15.250'"

# --- hour counts -------------------------------------------------------------------------------


@query("""SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS slot
FROM events""", name="hour_grid")
def hour_grid_query(spark, sf):
    return covered_hours(table(spark, sf, "events"), "ts")


@query("""SELECT date_trunc('hour', ts) AS slot, count(*) AS total_row_source FROM events
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1""", name="hourly_counts")
def hourly_counts_query(spark, sf):
    return hourly_counts(table(spark, sf, "events"), "ts", LOW, HIGH)


def _pair_sql(source_where: str = "TRUE", silver_where: str = "TRUE", low: str = "2024-01-01", high: str = "2024-01-31") -> str:
    return f"""grid AS (SELECT unnest(generate_series(TIMESTAMP '{low}', TIMESTAMP '{high}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS slot),
src AS (SELECT date_trunc('hour', ts) AS slot, count(*) AS n FROM events
  WHERE ts >= TIMESTAMP '{low}' AND ts < TIMESTAMP '{high}' AND ({source_where}) GROUP BY 1),
slv AS (SELECT date_trunc('hour', ts) AS slot, count(*) AS n FROM silver_events
  WHERE ts >= TIMESTAMP '{low}' AND ts < TIMESTAMP '{high}' AND ({silver_where}) GROUP BY 1),
pair AS (SELECT g.slot, coalesce(slv.n, 0) AS v, coalesce(src.n, 0) AS s
  FROM grid g LEFT JOIN slv ON slv.slot = g.slot LEFT JOIN src ON src.slot = g.slot)
"""


def _result_select(as_of: str = AS_OF_WIB_SQL, extra: str = "", day: str = "CAST(CAST(slot AS DATE) AS VARCHAR)",
                   source: str = "pair", where: str = "TRUE") -> str:
    return f"""SELECT md5(concat('{DB_SOURCE}|silver|events|{extra}', strftime(slot, '%Y-%m-%d'))) AS id, '{DB_SOURCE}' AS database_source,
  'silver' AS catalog_name, 'events' AS table_name, {day} AS created_at, strftime(slot, '%H:00:00') AS created_hours,
  CAST(v AS BIGINT) AS total_row_silver, CAST(s AS BIGINT) AS total_row_source, CASE WHEN v = s THEN 'SAME' ELSE 'DIFF' END AS status,
  CAST(abs(v - s) AS BIGINT) AS diff, CASE WHEN v > s THEN 'silver' WHEN v < s THEN 'source' ELSE 'same' END AS large,
  {as_of} AS ingestion_at FROM {source} WHERE {where}"""


def _chain(body: str, select: str, *inputs: str) -> str:
    return with_inputs("", *inputs).rstrip() + ",\n" + body + select


RECONCILE_SQL = _chain(_pair_sql(), _result_select(), "silver_events")


def _results(spark, sf, **options) -> DataFrame:
    return reconcile_check(options.pop("spec", SPEC), table(spark, sf, "events"), silver_events(spark, sf),
                           options.pop("low", LOW), options.pop("high", HIGH), database_source=DB_SOURCE,
                           **{"as_of": AS_OF, **options})


@query(RECONCILE_SQL)
def hourly_reconcile(spark, sf):
    return plain(_results(spark, sf))


@query(_chain(_pair_sql(), "SELECT slot, CAST(s AS BIGINT) AS total_row_source, CAST(v AS BIGINT) AS total_row_silver FROM pair",
              "silver_events"))
def hourly_compare(spark, sf):
    """Each side counted on its own, put on the grid, then joined."""
    grid = hour_grid(spark, LOW, HIGH)
    source = hourly_counts(table(spark, sf, "events"), "ts", LOW, HIGH)
    silver = hourly_counts(silver_events(spark, sf), "ts", LOW, HIGH, name=SILVER_ROWS)
    return compare_counts(fill_hours(grid, source, [SOURCE_ROWS]), fill_hours(grid, silver, [SILVER_ROWS])).select(
        SLOT, SOURCE_ROWS, SILVER_ROWS)


PRED_SPEC = CheckSpec("errors", "public", "events", "silver", "events", "ts", "ts", "event_type = 'error' OR value > 100",
                      "event_type = 'error' OR value > 100")
_PRED = "event_type = 'error' OR value > 100"


@query(_chain(_pair_sql(_PRED, _PRED), _result_select(), "silver_events"))
def reconcile_with_predicates(spark, sf):
    return plain(_results(spark, sf, spec=PRED_SPEC))


TYPES = ("click", "view", "purchase")
MANY = [CheckSpec(t, "public", "events", "silver", "events", "ts", "ts", f"event_type = '{t}'", f"event_type = '{t}'") for t in TYPES]
BROKEN = CheckSpec("broken", "public", "events", "silver", "events", "no_such_column", "ts")


def _many_sql() -> str:
    counts = """grid AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS slot),
kinds AS (SELECT unnest(['click', 'view', 'purchase']) AS kind),
src AS (SELECT date_trunc('hour', ts) AS slot, event_type AS kind, count(*) AS n FROM events GROUP BY ALL),
slv AS (SELECT date_trunc('hour', ts) AS slot, event_type AS kind, count(*) AS n FROM silver_events GROUP BY ALL),
pair AS (SELECT g.slot, k.kind, coalesce(slv.n, 0) AS v, coalesce(src.n, 0) AS s FROM grid g CROSS JOIN kinds k
  LEFT JOIN slv ON slv.slot = g.slot AND slv.kind = k.kind LEFT JOIN src ON src.slot = g.slot AND src.kind = k.kind)
"""
    select = _result_select().replace(
        f"concat('{DB_SOURCE}|silver|events|', ",
        f"concat('{DB_SOURCE}|silver|events|event_type = ''', kind, '''|event_type = ''', kind, '''|', ")
    return _chain(counts, select, "silver_events")


@query(_many_sql(), name="reconcile_many")
def reconcile_many_query(spark, sf):
    """Three checks and one that cannot be resolved, which is set aside."""
    outcome = reconcile_many(
        spark, [*MANY, BROKEN], lambda schema, name: table(spark, sf, name), lambda db, name: silver_events(spark, sf),
        LOW, HIGH, database_source=DB_SOURCE, as_of=AS_OF, include_predicates=True)
    if outcome.failed_ids != ("broken",):
        raise AssertionError(f"unexpected failures: {outcome.failed_ids}")
    return plain(outcome.results)


@query(_chain(_pair_sql(), _result_select(as_of=f"CASE WHEN slot < TIMESTAMP '2024-01-16' THEN {AS_OF_WIB_SQL} ELSE {AS_OF_LATER_WIB_SQL} END"),
              "silver_events"))
def reconcile_upsert_rerun(spark, sf):
    """A stored month whose second half is checked again."""
    return plain(upsert_results(_results(spark, sf), _results(spark, sf, low=HALF, as_of=AS_OF_LATER)))


# --- run logs ----------------------------------------------------------------------------------

_EXTRACT = """extracted AS (SELECT job, year, month, day, src, printf('%04d-%02d-%02d', year, month, day) AS dt,
  nullif(regexp_extract(src, '/logs/cron-batch/([^/]+)/', 1), '') AS source_name,
  coalesce(max(nullif(regexp_extract(line, '"pg_table"\\s*:\\s*"([^"]+)"', 1), '')),
           max(nullif(regexp_extract(line, '"prod_table"\\s*:\\s*"([^"]+)"', 1), ''))) AS table_name,
  max(nullif(regexp_extract(line, '"run_id"\\s*:\\s*"([^"]+)"', 1), '')) AS run_id,
  CAST(max(nullif(regexp_extract(line, '"exit_code"\\s*:\\s*([0-9]+)', 1), '')) AS INTEGER) AS exit_code,
  max(nullif(regexp_extract(line, '"status"\\s*:\\s*"([^"]+)"', 1), '')) AS status,
  max(nullif(regexp_extract(line, '"prod_table"\\s*:\\s*"([^"]+)"', 1), '')) AS prod_table
  FROM run_log_lines WHERE src LIKE '%/monitoring/status.json' GROUP BY job, year, month, day, src)
"""
_EXTRACT_COLUMNS = "job, year, month, day, src, dt, source_name, table_name, run_id, exit_code, status, prod_table"
_RATES = """count(*) AS total_jobs, count(*) FILTER ({good}) AS success_count, count(*) FILTER ({bad}) AS error_count,
  round(100 - round(count(*) FILTER ({good}) * CAST(100 AS DOUBLE) / count(*), 2), 2) AS error_rate_pct,
  round(count(*) FILTER ({good}) * CAST(100 AS DOUBLE) / count(*), 2) AS success_rate_pct"""
_OK = "lower(status) IN ('success', 'ok') AND exit_code = 0"


@query(_chain(_EXTRACT, f"SELECT {_EXTRACT_COLUMNS} FROM extracted", "run_log_lines"))
def runlog_extract(spark, sf):
    return extract_runs(run_log_lines(spark, sf)).select(*_EXTRACT_COLUMNS.split(", "))


@query(_chain(_EXTRACT, "SELECT dt, source_name AS source, table_name, " + _RATES.format(good=_OK, bad=f"NOT ({_OK})") +
              " FROM extracted WHERE dt BETWEEN '2024-01-03' AND '2024-01-28' GROUP BY 1, 2, 3", "run_log_lines"))
def runlog_report(spark, sf):
    return run_report(extract_runs(run_log_lines(spark, sf)), days=("2024-01-03", "2024-01-28"), ordered=True)


@query(_chain(_EXTRACT, f"""SELECT {_EXTRACT_COLUMNS} FROM extracted WHERE source_name = 'db1' AND job IN ('click', 'view')
  AND year = 2024 AND month = 1 AND day BETWEEN 5 AND 20""", "run_log_lines"))
def runlog_selection(spark, sf):
    lines = log_selection(run_log_lines(spark, sf), systems=["db1"], jobs=["click", "view"], year=2024, month=1,
                          days=(5, 20), path_like="%/monitoring/status.json")
    return extract_runs(lines).select(*_EXTRACT_COLUMNS.split(", "))


@query("""SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS job, CAST(floor(value) AS INTEGER) AS duration_seconds,
  concat('t_', event_type) AS pg_table FROM events""")
def runlog_documents(spark, sf):
    """Whole status documents parsed with their schema."""
    e = table(spark, sf, "events")
    documents = e.select(F.to_json(F.struct(
        F.col("event_id").cast("string").alias("run_id"), F.col("event_type").alias("job"),
        F.floor("value").cast("int").alias("duration_seconds"),
        F.concat(F.lit("t_"), "event_type").alias("pg_table"))).alias("value"))
    return runs_from_documents(documents).select("run_id", "job", "duration_seconds", "pg_table")


@query(with_inputs('SELECT dt, source, "TABLE_NAME" AS table_name, ' + _RATES.format(
    good="\"JOB_STATUS\" = 'OK'", bad="\"JOB_STATUS\" = 'ERR'") + " FROM dq_run_log WHERE source LIKE 'db_1' GROUP BY 1, 2, 3", "dq_run_log"))
def dq_run_report(spark, sf):
    return dq_report(dq_run_log(spark, sf), source_like="db_1")


@query(with_inputs("""SELECT dt, hour, source, count(*) FILTER ("JOB_STATUS" = 'OK') AS tables_ok,
  count(*) FILTER ("JOB_STATUS" = 'ERR') AS tables_err, CAST(sum("TOTAL_DURATIONS") AS BIGINT) AS sum_durations,
  CAST(epoch(max(CAST(replace("RUN_END_ISO", '+07:00', '') AS TIMESTAMP))) - epoch(min(CAST(replace("RUN_START_ISO", '+07:00', '') AS TIMESTAMP))) AS BIGINT) AS wall_seconds
FROM dq_run_log GROUP BY 1, 2, 3""", "dq_run_log"))
def run_totals(spark, sf):
    return totals(dq_run_log(spark, sf))


# --- KPIs --------------------------------------------------------------------------------------

_PCT = "round({part} * CAST(100 AS DOUBLE) / nullif({whole}, 0), 2)"
_GOOD_COUNT, _BAD_COUNT = f"count(*) FILTER ({_OK})", f"count(*) FILTER (NOT ({_OK}))"
_WEEK = "CAST(date_trunc('week', started_at) AS TIMESTAMP) AS week"


@query(with_inputs(f"""SELECT {_WEEK}, job, count(*) AS total_jobs, {_GOOD_COUNT} AS success_count,
  {_PCT.format(part=_GOOD_COUNT, whole='count(*)')} AS success_rate_pct FROM runs GROUP BY 1, 2""", "runs"))
def kpi_success(spark, sf):
    return kpi.success_rate(runs(spark, sf))


_P95 = """p95 AS (SELECT CAST(started_at AS DATE) AS day, job, quantile_cont(duration_seconds, 0.95) AS p95_seconds FROM runs GROUP BY 1, 2),
graded AS (SELECT CAST(day AS VARCHAR) AS day, p.job, p95_seconds, slo_seconds, CASE WHEN p95_seconds / slo_seconds <= 1 THEN 'green'
  WHEN p95_seconds / slo_seconds <= 1.25 THEN 'amber' WHEN p95_seconds / slo_seconds > 1.25 THEN 'red' END AS grade
  FROM p95 p LEFT JOIN job_sla s ON s.job = p.job)
"""


@query(_chain(_P95, "SELECT * FROM graded", "runs", "job_sla"))
def kpi_p95(spark, sf):
    return plain(kpi.runtime_p95(runs(spark, sf), job_sla(spark, sf)))


@query(with_inputs("""SELECT job, date_trunc('week', started_at) AS week, count(*) AS runs, TRUE AS p95_in_bound, TRUE AS median_in_bound FROM runs GROUP BY 1, 2""", "runs"))
def kpi_sketched_runtime(spark, sf):
    """Weekly quantiles from stored daily sketches; their true ranks lie within half a per cent of those asked for."""
    path, r = scratch_path(spark, "sketches"), runs(spark, sf)
    kpi.runtime_sketches(r).write.parquet(path)
    found = kpi.sketched_runtime(spark.read.parquet(path))
    seen = r.select("job", trunc("week", F.col("started_at")).alias("week"), "duration_seconds").join(found, ["job", "week"])

    def in_bound(name: str, rank: float):
        below, upto = (F.avg((F.col("duration_seconds") < F.col(name)).cast("int")), F.avg((F.col("duration_seconds") <= F.col(name)).cast("int")))
        return (below <= rank + 0.005) & (upto >= rank - 0.005)

    return seen.groupBy("job", "week", "runs").agg(in_bound("p95_seconds", 0.95).alias("p95_in_bound"), in_bound("median_seconds", 0.5).alias("median_in_bound"))


_RECOVER = f"""marked AS (SELECT *, first_value(CASE WHEN {_OK} THEN ended_at END IGNORE NULLS) OVER (
  PARTITION BY job ORDER BY started_at, run_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS recovered_at FROM runs),
failed AS (SELECT {_WEEK}, job, run_id, started_at, recovered_at, CAST(epoch(recovered_at) - epoch(started_at) AS BIGINT) AS seconds
  FROM marked WHERE NOT ({_OK}))
"""


@query(_chain(_RECOVER, "SELECT job, run_id, started_at, recovered_at FROM failed", "runs"))
def kpi_recoveries(spark, sf):
    return kpi.recoveries(runs(spark, sf))


@query(_chain(_RECOVER, """SELECT week, job, count(*) AS failed_runs, count(seconds) AS recovered_runs,
  quantile_cont(seconds, 0.5) AS mttr_seconds FROM failed GROUP BY 1, 2""", "runs"))
def kpi_mttr(spark, sf):
    return kpi.mttr(runs(spark, sf))


_ON_TIME = """ended_at + INTERVAL 7 HOUR < CAST(concat(strftime(started_at + INTERVAL 7 HOUR, '%Y-%m-%d '), cutoff_wib) AS TIMESTAMP)"""


@query(with_inputs(f"""SELECT {_WEEK}, r.job, count(*) AS total_jobs, count(*) FILTER ({_ON_TIME}) AS on_time_count,
  {_PCT.format(part=f'count(*) FILTER ({_ON_TIME})', whole='count(*)')} AS on_time_pct
  FROM runs r JOIN job_sla s ON s.job = r.job GROUP BY 1, 2""", "runs", "job_sla"))
def kpi_ontime(spark, sf):
    return kpi.on_time(runs(spark, sf), job_sla(spark, sf))


@query(with_inputs(f"""SELECT {_WEEK}, job, quantile_cont(CAST(epoch(ended_at) - epoch(scheduled_at) AS BIGINT), 0.5) AS median_lag_seconds,
  quantile_cont(CAST(epoch(ended_at) - epoch(scheduled_at) AS BIGINT), 0.95) AS p95_lag_seconds FROM runs GROUP BY 1, 2""", "runs"))
def kpi_freshness(spark, sf):
    return kpi.freshness(runs(spark, sf))


_CHECKS = _pair_sql() + ", checks AS (" + _result_select(day="CAST(slot AS DATE)") + ")\n"
_DQ_PASS = """both_sides AS (
  SELECT CAST(date_trunc('week', CAST(dt AS DATE)) AS TIMESTAMP) AS week, 'runs' AS measure, count(*) AS total,
    count(*) FILTER ("JOB_STATUS" = 'OK') AS passed FROM dq_run_log GROUP BY 1
  UNION ALL SELECT CAST(date_trunc('week', created_at) AS TIMESTAMP), 'checks', count(*), count(*) FILTER (status = 'SAME') FROM checks GROUP BY 1)
"""


@query(_chain(_CHECKS + ", " + _DQ_PASS, f"SELECT *, {_PCT.format(part='passed', whole='total')} AS pass_pct FROM both_sides",
              "silver_events", "dq_run_log"))
def kpi_dq_pass(spark, sf):
    return kpi.dq_pass_rate(dq_run_log(spark, sf), _results(spark, sf))


@query(_chain(_CHECKS, """SELECT CAST(date_trunc('week', created_at) AS TIMESTAMP) AS week, CAST(sum(diff) AS BIGINT) AS sum_diff,
  CAST(sum(total_row_source) AS BIGINT) AS sum_source, round(sum(diff) * CAST(100 AS DOUBLE) / nullif(sum(total_row_source), 0), 4) AS diff_rate_pct
  FROM checks GROUP BY 1""", "silver_events"))
def kpi_diff_rate(spark, sf):
    return kpi.diff_rate(_results(spark, sf))


def _event_checks(spark, sf) -> DataFrame:
    """Every event read as a check of its type's table on its day."""
    return table(spark, sf, "events").select(
        F.to_date("ts").alias("created_at"), F.concat(F.lit("shop_"), (F.col("user_id") % 2).cast("string")).alias("catalog_name"),
        F.col("event_type").alias("table_name"))


@query("""WITH scope AS (SELECT DISTINCT concat('shop_', CAST(user_id % 3 AS VARCHAR)) AS c, event_type AS t FROM events),
seen AS (SELECT DISTINCT CAST(ts AS DATE) AS d, concat('shop_', CAST(user_id % 2 AS VARCHAR)) AS c, event_type AS t FROM events),
days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM seen),
hits AS (SELECT d, count(*) AS n FROM seen JOIN scope USING (c, t) GROUP BY 1)
SELECT CAST(d AS VARCHAR) AS day, coalesce(n, 0) AS tables_checked, (SELECT count(*) FROM scope) AS tables_in_scope,
  round(coalesce(n, 0) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM scope), 2) AS coverage_pct FROM days LEFT JOIN hits USING (d)""")
def kpi_coverage(spark, sf):
    """A third of the scope, the tables of shop_2, is never checked."""
    scope = table(spark, sf, "events").select(
        F.concat(F.lit("shop_"), (F.col("user_id") % 3).cast("string")).alias("catalog_name"), F.col("event_type").alias("table_name"))
    return plain(kpi.dq_coverage(_event_checks(spark, sf), scope))


@query(with_inputs(f"""SELECT {_WEEK}, count(*) AS total_jobs, {_BAD_COUNT} AS error_count,
  {_PCT.format(part=_BAD_COUNT, whole='count(*)')} AS reruns_per_100 FROM runs GROUP BY 1""", "runs"))
def kpi_reruns(spark, sf):
    return kpi.reruns(runs(spark, sf))


_TREND = """medians AS (SELECT job, CAST(date_trunc('quarter', started_at) AS TIMESTAMP) AS quarter, quantile_cont(duration_seconds, 0.5) AS median_seconds
  FROM order_runs GROUP BY 1, 2),
trend AS (SELECT m.job, m.quarter, m.median_seconds, b.median_seconds AS previous_seconds FROM medians m
  LEFT JOIN medians b ON b.job = m.job AND b.quarter = m.quarter - INTERVAL 3 MONTH)
"""


@query(_chain(_TREND, """SELECT *, round((previous_seconds - median_seconds) * 100 / nullif(previous_seconds, 0), 2) AS improvement_pct FROM trend""",
              "order_runs"))
def kpi_runtime_trend(spark, sf):
    return kpi.runtime_trend(order_runs(spark, sf))


@query(with_inputs("""SELECT CAST(g.d AS VARCHAR) AS day, coalesce(n, 0) AS jobs_reporting, (SELECT count(DISTINCT event_type) FROM events) + (SELECT count(*) FROM region) AS jobs_in_scope,
  round(coalesce(n, 0) * CAST(100 AS DOUBLE) / ((SELECT count(DISTINCT event_type) FROM events) + (SELECT count(*) FROM region)), 2) AS onboarded_pct
FROM (SELECT CAST(unnest(generate_series(min(CAST(started_at AS DATE)), max(CAST(started_at AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM runs) g
LEFT JOIN (SELECT d, count(*) AS n FROM (SELECT DISTINCT CAST(started_at AS DATE) AS d, job FROM runs) x GROUP BY 1) h ON h.d = g.d""", "runs"))
def kpi_onboarding(spark, sf):
    """Jobs named like regions are in scope and never report."""
    scope = table(spark, sf, "events").select(F.col("event_type").alias("job")).union(table(spark, sf, "region").select("r_name"))
    return plain(kpi.onboarding(runs(spark, sf), scope))


_MEASURES = f"""success AS (SELECT date_trunc('week', started_at) AS w, round({_GOOD_COUNT} * CAST(100 AS DOUBLE) / count(*), 2) AS value FROM runs GROUP BY 1),
ratio AS (SELECT date_trunc('week', CAST(day AS TIMESTAMP)) AS w, max(p95_seconds / slo_seconds) AS value FROM graded GROUP BY 1),
recover AS (SELECT week AS w, quantile_cont(seconds, 0.5) / 60 AS value FROM failed GROUP BY 1),
timely AS (SELECT date_trunc('week', started_at) AS w, round(count(*) FILTER ({_ON_TIME}) * CAST(100 AS DOUBLE) / count(*), 2) AS value
  FROM runs r JOIN job_sla s ON s.job = r.job GROUP BY 1),
passing AS (SELECT week AS w, min(round(passed * CAST(100 AS DOUBLE) / total, 2)) AS value FROM both_sides GROUP BY 1),
gaps AS (SELECT date_trunc('week', created_at) AS w, round(sum(diff) * CAST(100 AS DOUBLE) / nullif(sum(total_row_source), 0), 4) AS value FROM checks GROUP BY 1),
measures AS (SELECT w, 'success_rate' AS kpi, value FROM success UNION ALL SELECT w, 'p95_runtime', value FROM ratio
  UNION ALL SELECT w, 'mttr', value FROM recover UNION ALL SELECT w, 'on_time', value FROM timely
  UNION ALL SELECT w, 'dq_pass', value FROM passing UNION ALL SELECT w, 'diff_rate', value FROM gaps),
limits AS (SELECT * FROM (VALUES ('success_rate', 0.30, 99.5, 98.0, TRUE), ('p95_runtime', 0.20, 1.0, 1.25, FALSE), ('mttr', 0.15, 60.0, 120.0, FALSE),
  ('on_time', 0.15, 98.0, 95.0, TRUE), ('dq_pass', 0.15, 99.0, 98.0, TRUE), ('diff_rate', 0.05, 0.10, 0.25, FALSE)) v(kpi, weight, green, amber, up))
"""


@query(_chain(_P95 + "," + _RECOVER + "," + _CHECKS + "," + _DQ_PASS + "," + _MEASURES, """SELECT CAST(w AS TIMESTAMP) AS period, m.kpi, round(value, 4) AS value,
  CAST(weight AS DOUBLE) AS weight, CASE WHEN value IS NULL THEN NULL WHEN (up AND value >= green) OR (NOT up AND value <= green) THEN 'green'
  WHEN (up AND value >= amber) OR (NOT up AND value <= amber) THEN 'amber' ELSE 'red' END AS grade
FROM measures m JOIN limits l ON l.kpi = m.kpi""", "runs", "job_sla", "silver_events", "dq_run_log"))
def kpi_scorecard(spark, sf):
    """All graded measures per week."""
    r, sla, results = runs(spark, sf), job_sla(spark, sf), stable(_results(spark, sf))
    weekly = {
        "success_rate": kpi.success_rate(r).groupBy("week").agg(
            rate_pct(F.sum("success_count"), F.sum("total_jobs")).alias("value")),
        "p95_runtime": kpi.runtime_p95(r, sla).groupBy(kpi.week_of(F.col("day").cast("timestamp_ntz")).alias("week")).agg(
            F.max(F.col("p95_seconds") / F.col("slo_seconds")).alias("value")),
        "mttr": kpi.mttr(r, by=["week"]).select("week", (F.col("mttr_seconds") / 60).alias("value")),
        "on_time": kpi.on_time(r, sla).groupBy("week").agg(rate_pct(F.sum("on_time_count"), F.sum("total_jobs")).alias("value")),
        "dq_pass": kpi.dq_pass_rate(dq_run_log(spark, sf), results).groupBy("week").agg(F.min("pass_pct").alias("value")),
        "diff_rate": kpi.diff_rate(results).select("week", F.col("diff_rate_pct").alias("value")),
    }
    measures = None
    for name, frame in weekly.items():
        part = frame.select(F.col("week").alias("period"), F.lit(name).alias("kpi"), F.col("value").cast("double").alias("value"))
        measures = part if measures is None else measures.unionAll(part)
    return kpi.scorecard(measures).withColumn("value", F.round("value", 4))
