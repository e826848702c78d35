"""Reliability, freshness and quality KPIs over run logs and check results.

Run frames have ``run_id, job, started_at, ended_at, duration_seconds, exit_code, status``.
Percentiles are exact: values are whole seconds or minutes, counted per distinct value first, so
the final aggregate sees one row per distinct value and not one per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.clock import seconds_between, to_wib, trunc
from ..functions.rules import rate_pct, run_succeeded
from ..schemas import KPI_THRESHOLD

# Scorecard weights and limits. Rates and the difference rate are percentages,
# p95_runtime is the ratio to the job's target, mttr is minutes.
THRESHOLDS = (
    ("success_rate", 0.30, 99.5, 98.0, True),
    ("p95_runtime", 0.20, 1.0, 1.25, False),
    ("mttr", 0.15, 60.0, 120.0, False),
    ("on_time", 0.15, 98.0, 95.0, True),
    ("dq_pass", 0.15, 99.0, 98.0, True),
    ("diff_rate", 0.05, 0.10, 0.25, False),
)
AMBER_RUNTIME = 1.25


def week_of(col: Column) -> Column:
    return trunc("week", col)


def _good() -> Column:
    return run_succeeded(F.col("status"), F.col("exit_code"))


def _percentiles(df: DataFrame, by: Sequence[Column], value: Column, wanted: dict[str, float]) -> DataFrame:
    """Exact percentiles of ``value`` per group."""
    names = [f"__g{i}" for i in range(len(by))]
    counted = df.groupBy(*(c.alias(n) for c, n in zip(by, names)), value.alias("__v")).agg(
        F.count(F.lit(1)).alias("__n"))
    return counted.groupBy(*names).agg(*(
        F.percentile("__v", F.lit(p), F.col("__n")).alias(name) for name, p in wanted.items()))


def success_rate(runs: DataFrame) -> DataFrame:
    """Per week and job."""
    good = _good()
    return runs.groupBy(week_of(F.col("started_at")).alias("week"), "job").agg(
        F.count(F.lit(1)).alias("total_jobs"), F.count_if(good).alias("success_count"),
        rate_pct(F.count_if(good), F.count(F.lit(1))).alias("success_rate_pct"))


def runtime_p95(runs: DataFrame, sla: DataFrame, *, approximate: bool = False) -> DataFrame:
    """P95 runtime per job and day with its grade against the job's target."""
    day = F.to_date("started_at")
    if approximate:
        p95 = runs.groupBy(day.alias("day"), "job").agg(
            F.percentile_approx("duration_seconds", 0.95).cast("double").alias("p95_seconds"))
    else:
        p95 = _percentiles(runs, [day, F.col("job")], F.col("duration_seconds"), {"p95_seconds": 0.95})
        p95 = p95.withColumnsRenamed({"__g0": "day", "__g1": "job"})
    ratio = F.col("p95_seconds") / F.col("slo_seconds")
    return p95.join(sla.select("job", "slo_seconds"), "job", "left").select(
        "day", "job", "p95_seconds", "slo_seconds",
        F.when(ratio <= 1, F.lit("green")).when(ratio <= AMBER_RUNTIME, F.lit("amber"))
        .when(ratio > AMBER_RUNTIME, F.lit("red")).alias("grade"))


def recoveries(runs: DataFrame) -> DataFrame:
    """Every failed run with the end of the job's next successful run (by start, then run id).

    One job may own most runs, so no task holds a whole job: the next success is looked up inside each
    day of a job, and a failure with none left that day takes the first success of the job's later
    days from a small summary of one row per job and day. Windows run newest first, which needs only a growing frame.
    """
    sliced = runs.select("job", "started_at", "run_id", "ended_at", _good().alias("__ok"), F.to_date("started_at").alias("__slice"))
    ok_end = F.when(F.col("__ok"), F.col("ended_at"))
    later = Window.partitionBy("job", "__slice").orderBy(
        F.col("started_at").desc(), F.col("run_id").desc()).rowsBetween(Window.unboundedPreceding, -1)
    within = sliced.withColumn("__near", F.last(ok_end, ignorenulls=True).over(later))

    first_ok = F.min(F.when(F.col("__ok"), F.struct("started_at", "run_id", "ended_at")))
    after = Window.partitionBy("job").orderBy(F.col("__slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy("job", "__slice").agg(first_ok["ended_at"].alias("__first"))
        .select("job", "__slice", F.last("__first", ignorenulls=True).over(after).alias("__far"))
    )
    failed = within.filter(F.coalesce(~F.col("__ok"), F.lit(False)))
    return failed.join(carried, ["job", "__slice"], "left").select(
        "job", "run_id", "started_at", F.coalesce("__near", "__far").alias("recovered_at"))


def mttr(runs: DataFrame, by: Sequence[str] = ("week", "job")) -> DataFrame:
    """Median seconds from a failed run's start to the end of the job's next success, per week and job.

    Failures without a later success are open incidents: counted, left out of the median.
    ``by=("week",)`` takes the median over all jobs.
    """
    took = recoveries(runs).select(
        week_of(F.col("started_at")).alias("week"), "job",
        seconds_between(F.col("started_at"), F.col("recovered_at")).alias("seconds"))
    counted = took.groupBy(*by, "seconds").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*by).agg(
        F.sum("n").alias("failed_runs"),
        F.coalesce(F.sum(F.when(F.col("seconds").isNotNull(), F.col("n"))), F.lit(0)).alias("recovered_runs"),
        F.percentile("seconds", F.lit(0.5), F.col("n")).alias("mttr_seconds"))


def on_time(runs: DataFrame, sla: DataFrame) -> DataFrame:
    """Share of runs that end before the job's Jakarta cutoff on the day they start, per week and job.

    A job without a cutoff is counted, with unknown (null) on-time figures.
    """
    cutoff = F.concat(F.date_format(to_wib(F.col("started_at")), "yyyy-MM-dd "), F.col("cutoff_wib"))
    hit = to_wib(F.col("ended_at")) < cutoff.try_cast("timestamp_ntz")
    joined = runs.join(sla.select("job", "cutoff_wib"), "job", "left")
    hits = F.when(F.count("cutoff_wib") > 0, F.count_if(hit))
    return joined.groupBy(week_of(F.col("started_at")).alias("week"), "job").agg(
        F.count(F.lit(1)).alias("total_jobs"), hits.alias("on_time_count"),
        rate_pct(hits, F.count(F.lit(1))).alias("on_time_pct"))


def freshness(runs: DataFrame) -> DataFrame:
    """Median and P95 of end minus scheduled time in seconds, per week and job."""
    lag = seconds_between(F.col("scheduled_at"), F.col("ended_at"))
    out = _percentiles(runs, [week_of(F.col("started_at")), F.col("job")], lag,
                       {"median_lag_seconds": 0.5, "p95_lag_seconds": 0.95})
    return out.withColumnsRenamed({"__g0": "week", "__g1": "job"})


def dq_pass_rate(run_log: DataFrame, results: DataFrame) -> DataFrame:
    """Weekly share of quality runs that ended ``OK`` and of hourly checks that found no gap."""
    runs = run_log.groupBy(week_of(F.col("dt").cast("timestamp_ntz")).alias("week")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("JOB_STATUS") == "OK").alias("passed"))
    checks = results.groupBy(week_of(F.col("created_at").cast("timestamp_ntz")).alias("week")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "SAME").alias("passed"))
    both = runs.withColumn("measure", F.lit("runs")).unionByName(checks.withColumn("measure", F.lit("checks")))
    return both.select("week", "measure", "total", "passed", rate_pct(F.col("passed"), F.col("total")).alias("pass_pct"))


def diff_rate(results: DataFrame, period: str = "week") -> DataFrame:
    """Summed gaps over summed source rows, in percent."""
    return results.groupBy(trunc(period, F.col("created_at").cast("timestamp_ntz")).alias(period)).agg(
        F.sum(F.abs("diff")).alias("sum_diff"), F.sum("total_row_source").alias("sum_source"),
        F.round(F.sum(F.abs("diff")) * F.lit(100.0).cast("double") / F.nullif(F.sum("total_row_source"), F.lit(0)), 4)
        .alias("diff_rate_pct"))


def _scope_share(seen: DataFrame, scope: DataFrame, day: str, keys: Sequence[str], names: tuple[str, str, str]) -> DataFrame:
    """Per day from the first to the last of ``seen``, how many scope members were seen; a day without any counts 0.

    Repeats collapse before the join.
    """
    members = scope.select(*keys).distinct()
    daily = seen.select(day, *keys).distinct().join(members, list(keys), "left_semi")
    hits = daily.groupBy(day).agg(F.count(F.lit(1)).alias("__hit"))
    whole = members.agg(F.count(F.lit(1))).scalar()
    span = seen.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).filter("lo is not null")
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(day))
    hit, total, share = names
    return (
        days.join(hits, day, "left").select(day, F.coalesce("__hit", F.lit(0)).alias(hit))
        .withColumn(total, whole)
        .withColumn(share, rate_pct(F.col(hit), F.col(total)))
    )


def dq_coverage(results: DataFrame, scope: DataFrame) -> DataFrame:
    """Per day, tables in scope with at least one check."""
    return _scope_share(results.select(F.col("created_at").alias("day"), "catalog_name", "table_name"), scope, "day",
                        ["catalog_name", "table_name"], ("tables_checked", "tables_in_scope", "coverage_pct"))


def onboarding(runs: DataFrame, scope: DataFrame) -> DataFrame:
    """Per day, jobs in scope that wrote a status record."""
    return _scope_share(runs.select(F.to_date("started_at").alias("day"), "job"), scope, "day", ["job"],
                        ("jobs_reporting", "jobs_in_scope", "onboarded_pct"))


def reruns(runs: DataFrame) -> DataFrame:
    """Failed runs per 100, weekly."""
    good = _good()
    return runs.groupBy(week_of(F.col("started_at")).alias("week")).agg(
        F.count(F.lit(1)).alias("total_jobs"), F.count_if(~good).alias("error_count"),
        rate_pct(F.count_if(~good), F.count(F.lit(1))).alias("reruns_per_100"))


def runtime_sketches(runs: DataFrame, size: int = 1024) -> DataFrame:
    """A quantile sketch of the runtimes per job and day, to be stored: ``day, job, runs, sketch``.

    Later periods merge the stored sketches and never read the runs again. ``size`` is the KLL sketch's k: a rank is off by
    about 2.3 / k of all ranks at most, 0.3 % by default; up to k runs it is exact.
    """
    known = runs.where("duration_seconds is not null")
    return known.groupBy(F.to_date("started_at").alias("day"), "job").agg(
        F.count(F.lit(1)).alias("runs"), F.kll_sketch_agg_bigint(F.col("duration_seconds").cast("bigint"), F.lit(size)).alias("sketch"))


def sketched_runtime(sketches: DataFrame, period: str = "week", wanted: dict[str, float] | None = None, size: int = 1024) -> DataFrame:
    """Runtime quantiles per job and ``period`` (week, month, quarter) from stored daily sketches: ``period, job, runs`` and one column each."""
    merged = sketches.groupBy(trunc(period, F.col("day").cast("timestamp_ntz")).alias(period), "job").agg(
        F.sum("runs").alias("runs"), F.kll_merge_agg_bigint("sketch", F.lit(size)).alias("__sketch"))
    quantiles = wanted or {"median_seconds": 0.5, "p95_seconds": 0.95}
    return merged.select(period, "job", "runs", *(F.kll_sketch_get_quantile_bigint("__sketch", F.lit(q)).alias(n) for n, q in quantiles.items()))


def runtime_trend(runs: DataFrame) -> DataFrame:
    """Median runtime per job and quarter and its change against the quarter before."""
    out = _percentiles(runs, [F.col("job"), trunc("quarter", F.col("started_at"))], F.col("duration_seconds"),
                       {"median_seconds": 0.5}).withColumnsRenamed({"__g0": "job", "__g1": "quarter"})
    by_quarter = Window.partitionBy("job").orderBy("quarter")
    adjacent = F.months_between("quarter", F.lag("quarter").over(by_quarter)) == 3
    before = F.when(adjacent, F.lag("median_seconds").over(by_quarter))
    return out.select("job", "quarter", "median_seconds", before.alias("previous_seconds")).withColumn(
        "improvement_pct",
        F.round((F.col("previous_seconds") - F.col("median_seconds")) * 100 / F.nullif(F.col("previous_seconds"), F.lit(0.0)), 2))


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(THRESHOLDS), KPI_THRESHOLD)


def scorecard(measures: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """Grade each ``(period, kpi, value)`` green, amber or red and attach the KPI's weight.

    An unknown value and a KPI without limits have no grade. There is no combined score: none is defined.
    """
    limits = thresholds(measures.sparkSession) if limits is None else limits
    up, value = F.col("higher_is_better"), F.col("value")

    def within(limit: str) -> Column:
        return (up & (value >= F.col(limit))) | (~up & (value <= F.col(limit)))

    grade = F.when(value.isNull() | up.isNull(), F.lit(None)).when(within("green"), F.lit("green")).when(
        within("amber"), F.lit("amber")).otherwise(F.lit("red"))
    return measures.join(limits, "kpi", "left").select("period", "kpi", "value", "weight", grade.alias("grade"))
