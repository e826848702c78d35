import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.clock import trunc
from tidemark.operators import kpi
from tidemark.operators import reconcile as R
from tidemark.operators.runlog import extract_runs, run_report, run_totals
from tidemark.schemas import DQ_RESULT

LOW, HIGH = datetime(2024, 1, 1), datetime(2024, 1, 2)
SPEC = R.CheckSpec(" c ", "public", "t", "silver", "t", "ts", "ts")


def events(spark, offsets):
    return spark.createDataFrame([(i, LOW + timedelta(minutes=m)) for i, m in enumerate(offsets)], "i int, ts timestamp_ntz")


def check(source, silver, **kw):
    return R.reconcile_check(SPEC, source, silver, LOW, HIGH, database_source="db", as_of=datetime(2024, 1, 3), **kw)


def test_grid_and_self_reconcile(spark):
    assert R.hour_grid(spark, LOW, HIGH).count() == 24
    assert R.hour_grid(spark, LOW + timedelta(minutes=30), LOW + timedelta(hours=2)).count() == 2
    same = events(spark, range(0, 1440, 7))
    out = check(same, same)
    assert out.schema == DQ_RESULT or [f.dataType for f in out.schema] == [f.dataType for f in DQ_RESULT]
    assert {(r.status, r.large, r["diff"]) for r in out.collect()} == {("SAME", "same", 0)} and out.count() == 24


def test_one_shuffle_form_equals_joined_form(spark):
    source, silver = events(spark, [0, 1, 61, 200, 200]), events(spark, [0, 61, 62, 300])
    grid = R.hour_grid(spark, LOW, HIGH)
    joined = R.compare_counts(
        R.fill_hours(grid, R.hourly_counts(source, "ts", LOW, HIGH), [R.SOURCE_ROWS]),
        R.fill_hours(grid, R.hourly_counts(silver, "ts", LOW, HIGH, name=R.SILVER_ROWS), [R.SILVER_ROWS]))
    single = R.fill_hours(grid, R.count_both(SPEC, source, silver, LOW, HIGH), [R.SOURCE_ROWS, R.SILVER_ROWS])
    assert sorted(joined.select(R.SLOT, R.SOURCE_ROWS, R.SILVER_ROWS).collect()) == sorted(
        single.select(R.SLOT, R.SOURCE_ROWS, R.SILVER_ROWS).collect())
    got = {r.created_hours: (r.total_row_source, r.total_row_silver, r.status, r.large) for r in check(source, silver).collect()}
    assert got["00:00:00"] == (2, 1, "DIFF", "source") and got["01:00:00"] == (1, 2, "DIFF", "silver")
    assert got["05:00:00"] == (0, 1, "DIFF", "silver") and got["06:00:00"] == (0, 0, "SAME", "same")


def test_many_checks_and_rerun(spark):
    df = events(spark, [0, 1])
    bad = R.CheckSpec("bad", "public", "t", "silver", "t", "nope", "ts")
    lost = R.CheckSpec("lost", "public", "missing", "silver", "t", "ts", "ts")
    tables = {"t": df}
    run = lambda specs: R.reconcile_many(
        spark, specs, lambda s, n: tables[n], lambda d, n: df, LOW, HIGH, database_source="db", as_of=LOW)
    outcome = run([bad, SPEC, lost])
    assert outcome.failed_ids == ("bad", "lost") and outcome.results.count() == 24 and outcome.failures.count() == 2
    nothing = run([bad])
    assert nothing.results.schema == DQ_RESULT and nothing.results.isEmpty()
    with pytest.raises(ValueError, match="no check result"):
        R.require_rows(nothing.results, True)
    again = check(df, events(spark, [0]))
    stored = R.upsert_results(outcome.results, again)
    assert stored.count() == 24 and stored.filter("status = 'DIFF'").count() == 1
    assert check(df, df, include_predicates=True).first().id != check(df, df).first().id
    with pytest.raises(ValueError, match="check needs"):
        R.CheckSpec("x", "", "t", "d", "t", "ts", "ts")


def brute_recoveries(rows):
    out = {}
    for job, start, run, end, ok in rows:
        if not ok:
            later = sorted((s, r, e) for j, s, r, e, o in rows if j == job and o and (s, r) > (start, run))
            out[(job, run)] = later[0][2] if later else None
    return out


@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_recoveries_against_brute_force_with_a_hot_job(spark, partitions):
    rng = random.Random(3)
    rows = []
    for i in range(700):
        job = "hot" if i % 3 else f"j{i % 5}"
        start = LOW + timedelta(seconds=rng.choice([5, rng.randrange(4000)]))
        rows.append((job, start, f"r{i:04d}", start + timedelta(seconds=rng.randrange(300)), rng.random() < 0.3))
    runs = spark.createDataFrame([(j, s, r, e, "ok" if o else "ERROR", 0 if o else 1) for j, s, r, e, o in rows],
                                 "job string, started_at timestamp_ntz, run_id string, ended_at timestamp_ntz, status string, exit_code int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = {(r.job, r.run_id): r.recovered_at for r in kpi.recoveries(runs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert got == brute_recoveries(rows)


def test_percentiles_match_the_builtin(spark):
    runs = spark.range(1000).select(
        F.lit("j").alias("job"), F.lit(LOW).cast("timestamp_ntz").alias("started_at"), (F.col("id") * 37 % 211).alias("duration_seconds"))
    sla = spark.createDataFrame([("j", "18:00:00", 180)], "job string, cutoff_wib string, slo_seconds int")
    row = kpi.runtime_p95(runs, sla).first()
    assert row.p95_seconds == runs.agg(F.percentile("duration_seconds", 0.95)).first()[0]
    assert row.grade == "amber"
    assert abs(kpi.runtime_p95(runs, sla, approximate=True).first().p95_seconds - row.p95_seconds) <= 1


def test_on_time_crosses_midnight(spark):
    rows = [("a", datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 59), 0, "ok"),    # 17:59 WIB
            ("a", datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11, 0), 0, "ok"),     # 18:00 WIB
            ("a", datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 18, 0), 0, "ok")]     # 01:00 WIB next day
    runs = spark.createDataFrame(rows, "job string, started_at timestamp_ntz, ended_at timestamp_ntz, exit_code int, status string")
    sla = spark.createDataFrame([("a", "18:00:00", 1)], "job string, cutoff_wib string, slo_seconds int")
    assert kpi.on_time(runs, sla).first().on_time_count == 1


def test_trend_needs_the_adjacent_quarter(spark):
    rows = [("a", datetime(2024, 2, 1), 100), ("a", datetime(2024, 5, 1), 80), ("a", datetime(2024, 11, 1), 40)]
    out = {r.quarter.month: r for r in kpi.runtime_trend(
        spark.createDataFrame(rows, "job string, started_at timestamp_ntz, duration_seconds int")).collect()}
    assert out[4].improvement_pct == 20.0 and out[1].previous_seconds is None and out[10].previous_seconds is None


def test_scorecard_grades(spark):
    data = [("success_rate", 99.5, "green"), ("success_rate", 99.49, "amber"), ("success_rate", 97.9, "red"), ("p95_runtime", 1.25, "amber"),
            ("mttr", 121.0, "red"), ("diff_rate", 0.1, "green"), ("diff_rate", 0.26, "red"), ("on_time", None, None)]
    frame = spark.createDataFrame([(i, k, v) for i, (k, v, _) in enumerate(data)], "period int, kpi string, value double")
    got = [r.grade for r in kpi.scorecard(frame).orderBy("period").collect()]
    assert got == [g for *_, g in data]
    assert abs(kpi.thresholds(spark).agg(F.sum("weight")).first()[0] - 1) < 1e-9


def test_log_extraction(spark):
    path = "s3://b/logs/cron-batch/db1/j/2024/01/02/r1/monitoring/status.json"
    one_line = '{"run_id": "r1", "exit_code": 0, "status": "SUCCESS", "pg_table": "t", "duration_seconds": 61}'
    lines = [("j", 2024, 1, 2, path, one_line), ("j", 2024, 1, 2, path.replace("r1", "r2"), '"status": "weird",'),
             ("j", 2024, 1, 2, path.replace("r1", "r2"), '"staging_table": "stg",'),
             ("j", 2024, 1, 2, "x/log.txt", '"run_id": "no"')]
    runs = extract_runs(spark.createDataFrame(lines, "job string, year int, month int, day int, src string, line string"))
    got = {r.run_id: r for r in runs.collect()}
    assert got["r1"].exit_code == 0 and got["r1"].duration_seconds == 61 and got["r1"].source_name == "db1" and got["r1"].dt == "2024-01-02"
    assert got[None].table_name == "stg" and got[None].exit_code is None
    report = {r.table_name: r for r in run_report(runs).collect()}
    assert report["t"].success_rate_pct == 100.0 and report["t"].error_rate_pct == 0.0
    # a wrong status settles the outcome as failed even though the exit code is unknown
    assert (report["stg"].success_count, report["stg"].error_count, report["stg"].error_rate_pct) == (0, 1, 100.0)


def test_run_lines_are_dealt_out_before_they_are_sorted(spark, tmp_path):
    lines = [("j", 2024, 1, d, src, line) for d in (1, 2) for src in ("/db1/a/monitoring/status.json", None)
             for line in ('"run_id": "r",', f'"exit_code": {d}', None)]
    spark.createDataFrame(lines, "job string, year int, month int, day int, src string, line string").repartition(5).write.parquet(str(tmp_path / "lines"))
    runs = extract_runs(spark.read.parquet(str(tmp_path / "lines")), path_like=None)
    assert sorted((r.day, r.src or "", r.run_id, r.exit_code) for r in runs.collect()) == [
        (d, src, "r", d) for d in (1, 2) for src in ("", "/db1/a/monitoring/status.json")]
    # the sort would hold all the lines of a read task, many times its bytes in Parquet
    above, below = runs.filter("dt >= '2024-01-02'")._jdf.queryExecution().executedPlan().toString().split("Exchange")
    assert "Sort" in above and "Sort" not in below and "day" in below.split("DataFilters")[0]


def test_unknown_outcome_is_neither(spark):
    runs = spark.createDataFrame([("d", "s", "t", "ok", None), ("d", "s", "t", None, 0), ("d", "s", "t", "ok", 0)],
                                 "dt string, source_name string, table_name string, status string, exit_code int")
    row = run_report(runs).first()
    assert (row.total_jobs, row.success_count, row.error_count, row.error_rate_pct) == (3, 1, 0, 66.67)


def test_run_totals(spark):
    log = spark.createDataFrame([("OK", "2024-01-01T07:00:00+07:00", "2024-01-01T07:01:00+07:00", 60, "d", "07", "s"),
                                 ("ERR", "2024-01-01T07:02:00+07:00", "2024-01-01T07:05:00+07:00", 180, "d", "07", "s")],
                                "JOB_STATUS string, RUN_START_ISO string, RUN_END_ISO string, TOTAL_DURATIONS int, dt string, hour string, source string")
    row = run_totals(log).first()
    assert (row.tables_ok, row.tables_err, row.sum_durations, row.wall_seconds) == (1, 1, 240, 300)


def test_sketched_runtimes_stay_within_their_bound(spark):
    runs = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("job"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 91).cast("int"))).alias("started_at"),
        F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("int").alias("duration_seconds"))
    runs = runs.unionAll(runs.limit(5).withColumn("duration_seconds", F.lit(None).cast("int")))
    sketches = kpi.runtime_sketches(runs)
    for period in ("week", "quarter"):
        found = kpi.sketched_runtime(sketches, period, {"q50": 0.5, "q95": 0.95})
        exact = runs.groupBy(trunc(period, F.col("started_at")).alias(period), "job").agg(F.collect_list("duration_seconds").alias("all"), F.count("duration_seconds").alias("n"))
        rows = found.join(exact, [period, "job"]).collect()
        assert len(rows) == exact.count()
        for r in rows:
            assert r.runs == r.n
            for value, wanted in ((r.q50, 0.5), (r.q95, 0.95)):
                assert abs(sum(x <= value for x in r["all"]) / r.n - wanted) <= 0.004 + 1 / r.n
    few = kpi.sketched_runtime(kpi.runtime_sketches(runs.limit(0)))
    assert few.collect() == []
