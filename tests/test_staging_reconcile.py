from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.operators import kpi
from tidemark.operators.reconcile import CheckSpec, reconcile_many, run_checks
from tidemark.sinks.staging import write_staging


def test_staging_table_follows_path_schema_and_partitions(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a", "x")], "id long, v string, p string")
    write_staging(frame, str(tmp_path / "one"), table="stg_moving")
    write_staging(frame.withColumn("v", F.lit("b")), str(tmp_path / "two"), table="stg_moving")
    assert [r.v for r in spark.table("stg_moving").collect()] == ["b"]
    write_staging(frame.withColumn("v", F.lit("c")), str(tmp_path / "three"), table="stg_moving", partitions=["p"])
    assert [(r.v, r.p) for r in spark.table("stg_moving").collect()] == [("c", "x")]
    write_staging(frame.withColumn("p", F.lit("y")), str(tmp_path / "three"), table="stg_moving", partitions=["p"], mode="append")
    assert sorted(r.p for r in spark.table("stg_moving").collect()) == ["x", "y"]


LOW, HIGH = datetime(2024, 1, 1), datetime(2024, 1, 1, 3)


def checks(spark, run, predicates):
    source = spark.sql("select timestamp_ntz'2024-01-01 01:10:00' ts, id, cast(id % 2 as string) kind from range(10)")
    silver = source.filter("id <> 3")
    specs = [CheckSpec(f"c{i}", "p", "t", "s", "t", "ts", "ts", p, p) for i, p in enumerate(predicates)]
    return run(spark, specs, lambda s, t: source, lambda d, t: silver, LOW, HIGH, database_source="db", as_of=LOW, include_predicates=True)


def test_one_pass_counts_every_check(spark):
    outcome = checks(spark, reconcile_many, ["kind = '1'", "kind = '0'", "", "id / 0 > 1 and missing = 1"])
    assert outcome.failed_ids == ("c3",)
    rows = [(r.total_row_source, r.total_row_silver) for r in outcome.results.filter("total_row_source > 0").collect()]
    assert sorted(rows) == [(5, 4), (5, 5), (10, 9)] and outcome.results.count() == 9
    plan = outcome.results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 10") <= 2


def test_a_check_that_fails_while_running_costs_no_other(spark):
    outcome = checks(spark, run_checks, ["kind = '1'", "1 / (id - 3) > 0", "kind = '0'"])
    assert outcome.failed_ids == ("c1",) and outcome.results.count() == 6
    assert [r.check_id for r in outcome.failures.collect()] == ["c1"]


def test_days_without_checks_count_zero(spark):
    results = spark.createDataFrame([(date(2024, 1, 1), "c", "a"), (date(2024, 1, 3), "c", "a"), (date(2024, 1, 2), "c", "out")],
                                    "created_at date, catalog_name string, table_name string")
    scope = spark.createDataFrame([("c", "a"), ("c", "b")], "catalog_name string, table_name string")
    got = sorted(tuple(r) for r in kpi.dq_coverage(results, scope).select(F.col("day").cast("string"), "tables_checked", "tables_in_scope", "coverage_pct").collect())
    assert got == [("2024-01-01", 1, 2, 50.0), ("2024-01-02", 0, 2, 0.0), ("2024-01-03", 1, 2, 50.0)]


def test_jobs_without_target_and_measures_without_limits_stay(spark):
    runs = spark.createDataFrame([("a", datetime(2024, 1, 1), datetime(2024, 1, 1, 1)), ("b", datetime(2024, 1, 1), datetime(2024, 1, 1, 1))],
                                 "job string, started_at timestamp_ntz, ended_at timestamp_ntz")
    sla = spark.createDataFrame([("a", "23:00:00")], "job string, cutoff_wib string")
    got = {r.job: (r.total_jobs, r.on_time_count, r.on_time_pct) for r in kpi.on_time(runs, sla).collect()}
    assert got == {"a": (1, 1, 100.0), "b": (1, None, None)}
    measures = spark.createDataFrame([(datetime(2024, 1, 1), "new_kpi", 1.0)], "period timestamp_ntz, kpi string, value double")
    assert [(r.kpi, r.grade) for r in kpi.scorecard(measures).collect()] == [("new_kpi", None)]
