import json
import threading
from datetime import datetime

import pytest
from pyspark.sql import types as T

from tidemark.operators.upsert import MergeRules
from tidemark.plans import jobs
from tidemark.plans.jobs import REQUIRED_JOB_FIELDS, JobSpec
from tidemark.operators.reconcile import CheckSpec
from tidemark.sinks import silver
from tidemark.sources.changes import json_value, read_change_files
from tidemark.sources.logs import read_run_status
from tidemark.streaming import changes as S
from pyspark.sql import functions as F
from workload import moving

CHANGE = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.StringType()), T.StructField("at", T.LongType())])
ENVELOPE = T.StructType([T.StructField("after", CHANGE), T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])
FLAT = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("updated_at", T.StringType())])
TARGET = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("updated_at", T.TimestampNTZType())])


def test_flatten_and_decode(spark):
    texts = [json.dumps({"after": {"id": 1, "amount": "12.30", "at": 1704067200000001}, "op": "c", "ts_ms": 1704067200123}),
             json.dumps({"after": None, "op": "d", "ts_ms": 1704067200124}), None]
    topic = spark.createDataFrame([(t,) for t in texts], "value string").withColumn("value", json_value(F.col("value"), ENVELOPE))
    flat = S.flatten_changes(topic)
    rows = {r["__op"]: r for r in S.decode_changes(flat, {"amount": T.DecimalType(10, 2), "at": T.TimestampNTZType()}).collect()}
    assert set(rows) == {"c", "d"} and rows["d"].id is None
    assert str(rows["c"].amount) == "12.30" and rows["c"]["at"] == datetime(2024, 1, 1, 0, 0, 0, 1)
    assert rows["c"]["__ts_ms"] == datetime(2024, 1, 1, 0, 0, 0, 123000)


def write_changes(spark, path, rows):
    spark.createDataFrame(rows, FLAT).coalesce(1).write.mode("append").json(path)


def test_stream_upsert_survives_replay(spark, tmp_path):
    inbox, home = str(tmp_path / "in"), str(tmp_path / "t")
    silver.create_table(spark, "live", TARGET, home)
    write_changes(spark, inbox, [(1, "a", "2024-01-02"), (2, "b", "2024-01-01")])
    write_changes(spark, inbox, [(1, "late", "2024-01-01"), (1, "newest", "2024-01-03"), (3, "c", "2024-01-01")])
    rules = MergeRules(keys="id", guard="updated_at", op=None)

    def run(checkpoint):
        stream = read_change_files(spark, inbox, FLAT, files_per_batch=1)
        S.upsert_stream(stream, "live", rules, str(tmp_path / checkpoint), every=None).awaitTermination()
        return sorted((r.id, r.v) for r in spark.table("live").collect())

    expected = [(1, "newest"), (2, "b"), (3, "c")]
    assert run("ck1") == expected
    assert silver.stream_marks(spark, "live") == {S.stream_id(spark, str(tmp_path / "ck1")): 1}
    assert run("ck1") == expected            # nothing new
    assert run("ck2") == expected            # every file again, from another stream
    write_changes(spark, inbox, [(3, "C", "2024-02-01")])
    assert run("ck1")[-1] == (3, "C")


def test_new_checkpoint_of_the_same_name_loses_no_batch(spark, tmp_path):
    silver.create_table(spark, "renewed", TARGET, str(tmp_path / "t"))
    rules = MergeRules(keys="id", guard="updated_at", op=None)
    for number, rows in enumerate([[(1, "a", "2024-01-02")], [(2, "b", "2024-01-02")]]):
        write_changes(spark, str(tmp_path / f"in{number}"), rows)
        stream = read_change_files(spark, str(tmp_path / f"in{number}"), FLAT, files_per_batch=1)
        S.upsert_stream(stream, "renewed", rules, str(tmp_path / f"ck{number}" / "users"), every=None).awaitTermination()
    assert sorted(r.id for r in spark.table("renewed").collect()) == [1, 2]


def test_replay_after_another_writer_adds_no_null_keys(spark, tmp_path):
    silver.create_table(spark, "shared", TARGET, str(tmp_path / "t"))
    rules = MergeRules(keys="id", guard="updated_at", op=None)
    silver.merge_table(spark, "shared", spark.createDataFrame([(None, "n", "2024-01-01")], FLAT), rules, batch=("s", 4))
    silver.merge_table(spark, "shared", spark.createDataFrame([(9, "job", "2024-01-01")], FLAT), rules)
    assert silver.stream_marks(spark, "shared") == {"s": 4}
    for number in (3, 4):
        silver.merge_table(spark, "shared", spark.createDataFrame([(None, "n", "2024-01-01")], FLAT), rules, batch=("s", number))
    assert spark.table("shared").count() == 2


def test_second_writer_on_one_version_is_refused_or_merges_again(spark, tmp_path):
    silver.create_table(spark, "raced", TARGET, str(tmp_path / "t"))
    rules, planned = MergeRules(keys="id", guard=None, op=None), silver.table_location(spark, "raced")
    late = silver.merge_upsert(spark.table("raced"), spark.createDataFrame([(2, "late", "2024-01-01")], FLAT), rules)
    silver.merge_table(spark, "raced", spark.createDataFrame([(1, "first", "2024-01-01")], FLAT), rules)
    with pytest.raises(silver.TableMoved):
        silver.publish_version(spark, "raced", late, planned_on=planned)
    silver.merge_table(spark, "raced", spark.createDataFrame([(2, "late", "2024-01-01")], FLAT), rules)
    assert sorted(r.id for r in spark.table("raced").collect()) == [1, 2]


def test_streams_refuse_what_they_cannot_keep(spark, tmp_path):
    silver.create_table(spark, "parted", TARGET, str(tmp_path / "t"), partitions=["v"])
    write_changes(spark, str(tmp_path / "in"), [(1, "a", "2024-01-02")])
    stream = read_change_files(spark, str(tmp_path / "in"), FLAT, files_per_batch=1)
    with pytest.raises(ValueError, match="null_keys"):
        S.upsert_stream(stream, "parted", MergeRules(keys="id", guard="updated_at", op=None), str(tmp_path / "ck"), every=None)
    S.upsert_stream(stream, "parted", MergeRules(keys="id", guard="updated_at", op=None, null_keys="drop"), str(tmp_path / "ck"), every=None).awaitTermination()
    assert spark.table("parted").count() == 1
    with pytest.raises(ValueError, match="partitioned"):
        silver.publish_version(spark, "parted", spark.table("parted"))


def test_deletes_take_their_key_from_before_image_or_record_key(spark):
    image = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    envelope = T.StructType([T.StructField("before", image), T.StructField("after", image), T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])
    records = spark.createDataFrame([
        ((1,), ({"id": 1, "v": "old"}, None, "d", 1)), ((2,), (None, None, "d", 2)), (None, (None, None, "d", 3)),
        ((4,), ({"id": 4, "v": "old"}, {"id": 4, "v": None}, "u", 4)), ((5,), None)],
        T.StructType([T.StructField("key", T.StructType([T.StructField("id", T.LongType())])), T.StructField("value", envelope)]))
    got = sorted((r.id, r.v, r["__op"]) for r in S.flatten_changes(records, record_key="key", keys=["id"]).collect())
    assert got == [(1, "old", "d"), (2, None, "d"), (4, None, "u")]


def test_text_flags_of_a_job_row():
    row = {n: "x" for n in REQUIRED_JOB_FIELDS} | {"dedupe_source": "false", "align_ddl": "no", "debug": "TRUE", "align_by": "compat", "unknown": "1"}
    spec = JobSpec.from_row(row)
    assert (spec.dedupe_source, spec.align_ddl, spec.debug, spec.align_by) == (False, False, True, "compat")


def test_landing_folders(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("__ts_ms", T.TimestampNTZType())])
    spark.sql("select 1L id, timestamp_ntz'2024-01-01 05:10:00' __ts_ms union all select 2L, timestamp_ntz'2024-12-31 23:59:59'").coalesce(
        1).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    S.land_by_hour(stream, str(tmp_path / "out"), str(tmp_path / "ck"), every=None).awaitTermination()
    assert (tmp_path / "out" / "yyyy=2024" / "mm=12" / "dd=31" / "hh=23").is_dir()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_job_rows():
    row = {"job_name": "j", "pg_schema": "public", "pg_table": "t", "pg_sql": "SELECT 1", "s3_staging_path": "/x", "staging_table": "s",
           "prod_table": "p", "pk_col": "Order ID, id", "updated_at_col": "changed_at", "dedupe_tiebreakers": ""}
    spec = jobs.JobSpec.from_row(row)
    rules = spec.rules(["order_id", "id", "changed_at"])
    assert rules.keys == ("order_id", "id") and list(rules.tiebreakers) == ["changed_at", "order_id", "id"]
    assert (rules.op, rules.guard, rules.dedupe) == ("cron-2-hours", "changed_at", True)
    assert jobs.JobSpec.from_row({**row, "dedupe_source": False}).rules([]).dedupe is False
    with pytest.warns(UserWarning, match="pk_col"):
        assert jobs.JobSpec.from_row({**row, "pk_col": " "}) is None


def spec(tmp_path, name, prod, **kw):
    return jobs.JobSpec(name, "public", "t", "SELECT * FROM t", str(tmp_path / f"stg_{name}"), f"stg_{name}", prod, "id", "updated_at", **kw)


@pytest.mark.filterwarnings("ignore")
def test_failed_job_does_not_stop_the_rest(spark, tmp_path):
    silver.create_table(spark, "prod_a", TARGET, str(tmp_path / "a"))
    good = spec(tmp_path, "good", "prod_a", purge_staging=True)
    bad = spec(tmp_path, "bad", "prod_missing")
    ticks = iter(datetime(2024, 1, 1, 0, 0, s) for s in range(0, 60, 5))
    frame = spark.createDataFrame([("1", "x", "2024-01-01")], "ID string, V string, Updated_At string")
    status = jobs.run_jobs(spark, [bad, {"job_name": ""}, good], lambda s: frame, status_base=str(tmp_path / "logs"), clock=lambda: next(ticks))
    assert [(r.job, r.exit_code, r.status, r.duration_seconds) for r in status.collect()] == [("bad", 1, "ERROR", 5), ("good", 0, "SUCCESS", 5)]
    assert [(r.id, r.v) for r in spark.table("prod_a").collect()] == [(1, "x")]
    assert not spark.catalog.tableExists("stg_good")
    assert read_run_status(spark, str(tmp_path / "logs")).count() == 2


def test_jobs_side_by_side(spark, tmp_path):
    """Chains of one table keep their order, a failing job stops no other, statuses come in the order given."""
    for name in ("side_a", "side_b"):
        silver.create_table(spark, name, TARGET, str(tmp_path / name))
    batches = {"first": [("1", "one", "2024-01-01")], "second": [("1", "two", "2024-01-02"), ("2", "two", "2024-01-02")], "third": [("1", "late", "2024-01-01")],
               "other": [("9", "x", "2024-01-01")], "bad": [("1", "x", "2024-01-01")]}
    pools, together = {}, threading.Barrier(2, timeout=60)

    def extract(spec):
        pools[spec.job_name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        if spec.job_name in ("first", "other"):
            together.wait()  # both chains run at the same time
        return spark.createDataFrame(batches[spec.job_name], "ID string, V string, Updated_At string")

    rows = [spec(tmp_path, "first", "side_a"), spec(tmp_path, "bad", "side_missing"), spec(tmp_path, "other", "side_b"), spec(tmp_path, "second", "side_a"),
            spec(tmp_path, "third", "side_a")]
    status = jobs.run_jobs(spark, rows, extract, status_base=str(tmp_path / "logs"), at_once=3)
    assert [(r.job, r.status) for r in status.collect()] == [("first", "SUCCESS"), ("bad", "ERROR"), ("other", "SUCCESS"), ("second", "SUCCESS"), ("third", "SUCCESS")]
    assert sorted((r.id, r.v) for r in spark.table("side_a").collect()) == [(1, "two"), (2, "two")]
    assert [(r.id, r.v) for r in spark.table("side_b").collect()] == [(9, "x")]
    assert pools == {n: n for n in batches} and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert read_run_status(spark, str(tmp_path / "logs")).count() == 5


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def send(*rows):
        spark.createDataFrame([(k, datetime(2024, 1, 1, h, m)) for k, h, m in rows], "k int, at timestamp_ntz").coalesce(1).write.mode("append").parquet(inbox)
        rows = spark.readStream.schema("k int, at timestamp_ntz").parquet(inbox)
        (S.drop_repeats(rows, ["k"], "at", lateness="1 hour").writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
         .trigger(availableNow=True).start().awaitTermination())
        return sorted(r.k for r in spark.read.schema("k int").parquet(out).collect())

    assert send((1, 1, 0), (1, 1, 0), (2, 1, 5)) == [1, 2]
    assert send((2, 1, 5), (3, 1, 10)) == [1, 2, 3]      # a repeat in the next batch, and after a restart
    assert send((4, 9, 0)) == [1, 2, 3, 4]
    assert send((5, 2, 0), (6, 9, 5)) == [1, 2, 3, 4, 6]  # too late to be told from a repeat
    plan = spark.readStream.schema("k int, at timestamp_ntz").parquet(inbox)
    assert "DeduplicateWithinWatermark" in S.drop_repeats(plan, ["k"], "at")._jdf.queryExecution().analyzed().toString()


def test_new_log_files_alone_are_read(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "system string, job string, year int, month int, day int, src string, line string"

    def send(*runs):
        lines = [("s", "j", 2024, 1, 1, f"/db1/{r}/monitoring/status.json", line) for r, code in runs
                 for line in (f'"run_id": "{r}",', f'"exit_code": {code},', '"pg_table": "t",')]
        spark.createDataFrame(lines, schema).coalesce(1).write.mode("append").parquet(inbox)
        query = S.land_runs(spark.readStream.schema(schema).parquet(inbox), out, state, every=None)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress), sorted((r.run_id, r.exit_code) for r in S.landed_runs(spark, out).collect())

    assert send(("a", 0), ("b", 1)) == (6, [("a", 0), ("b", 1)])
    assert send(("c", 0)) == (3, [("a", 0), ("b", 1), ("c", 0)])  # three lines read, not nine


def test_more_runs_make_more_log_files_not_larger_ones(spark, tmp_path, monkeypatch):
    kinds, days = ("view", "click"), ("2024-01-02", "2024-01-03", "2024-01-28")
    events = [(i, kinds[i % 2], days[i % 3]) for i in range(1000)] + [(i, None, days[i % 3]) for i in range(1000, 1030)]
    (spark.createDataFrame(events, "event_id bigint, event_type string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
     .coalesce(1).write.parquet(str(tmp_path / "events.parquet")))
    monkeypatch.setattr(moving, "RUNS_PER_FILE", 40, raising=False)
    monkeypatch.setattr(moving, "scratch_path", lambda spark, label: str(tmp_path / label))
    expected = {}
    for i, kind, day in events[:1000]:
        if day > "2024-01-02":
            key = (day, f"db{i % 3}", f"p_{kind}" if i % 7 == 0 else f"t_{kind}")
            total, bad = expected.get(key, (0, 0))
            expected[key] = (total + 1, bad + (i % 11 == 0))
    # without a kind there is no path, so a day's runs are one file
    expected |= {(day, None, None): (1, int(any(i % 11 == 0 for i, _, d in events[1000:] if d == day))) for day in days[1:]}
    got = moving.stream_run_report(spark, str(tmp_path)).collect()
    assert {(r.dt, r.source, r.table_name): (r.total_jobs, r.error_count) for r in got} == expected and len(got) == len(expected)
    lines = spark.read.parquet(str(tmp_path / "run-lines")).groupBy(F.col("_metadata.file_path").alias("file"))
    assert max(r["count"] for r in lines.count().collect()) <= 2 * 5 * 40  # 25 files or so, five lines a run
    assert len(list((tmp_path / "runs").glob("batch=*"))) > 1
    files = spark.read.parquet(str(tmp_path / "run-lines")).groupBy("job", "day", "src").agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert files.filter("n > 1").isEmpty()  # all lines of a run's file together


def test_backfill_then_reconcile_is_all_same(spark, tmp_path):
    silver.ensure_database(spark, "jobdb", str(tmp_path))
    silver.create_table(spark, "jobdb.dest", TARGET, str(tmp_path / "dest"))
    silver.create_dq_result_table(spark, "jobdb.dq", str(tmp_path / "dq"))
    source = spark.range(200).select("id", F.lit("v").alias("v"),
                                     (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") % 24).cast("int"))).alias("updated_at"))
    source.createOrReplaceTempView("src_rows")
    jobs.backfill(spark, jobs.BackfillSpec("src_rows", "jobdb.dest", "id", filter_start="2024-01-01", filter_end="2024-01-02"))
    low, high = datetime(2024, 1, 1), datetime(2024, 1, 2)
    checks = [CheckSpec("ok", "public", "src_rows", "jobdb", "dest", "updated_at", "updated_at"),
              CheckSpec("bad", "public", "src_rows", "jobdb", "nope", "updated_at", "updated_at")]
    for _ in range(2):
        outcome = jobs.reconcile(spark, checks, lambda s, t: spark.table(t), low, high, "jobdb.dq", database_source="db")
    assert outcome.failed_ids == ("bad",)
    stored = spark.table("jobdb.dq")
    assert stored.count() == 24 and stored.filter("status <> 'SAME'").isEmpty()
    with pytest.raises(ValueError, match="no check result"):
        jobs.reconcile(spark, checks[1:], lambda s, t: spark.table(t), low, high, "jobdb.dq", database_source="db", fail_on_empty=True)
