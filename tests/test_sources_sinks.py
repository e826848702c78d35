import json
import threading
from pathlib import Path
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.runlog import extract_runs
from tidemark.operators.upsert import MergeRules, merge_upsert
from tidemark.schemas import DQ_RESULT, RUN_STATUS
from tidemark.session import estimated_bytes, fits_broadcast, scratch_path
from tidemark.sinks import logs, silver
from tidemark.sinks.staging import drop_staging, read_staging, staging_frame, table_location, write_staging
from tidemark.sources import relations
from tidemark.sources.logs import read_dq_run_log, read_run_status
from tidemark.sources.partitioned import folder_patterns, read_hours, read_run_logs, with_source_file

ROW = T.StructType([T.StructField("i", T.LongType())])


def hours_of(patterns, low, high):
    """Hours matched by the patterns, by brute force over a generous range."""
    import fnmatch

    at, out = low.replace(minute=0) - timedelta(days=400), []
    while at < high + timedelta(days=400):
        if any(fnmatch.fnmatch(f"{at:%Y/%m/%d/%H}", p) for p in patterns):
            out.append(at)
        at += timedelta(hours=1)
    return out


@pytest.mark.parametrize("low,high", [
    (datetime(2024, 2, 28, 22), datetime(2024, 3, 2, 3)), (datetime(2023, 12, 31, 23), datetime(2025, 1, 1, 1)),
    (datetime(2024, 1, 1), datetime(2024, 1, 1, 1)), (datetime(2024, 12, 1), datetime(2025, 2, 1)),
    (datetime(2024, 1, 5, 7, 30), datetime(2024, 1, 5, 9, 15)), (datetime(2024, 1, 1), datetime(2024, 1, 1)),
])
def test_patterns_cover_the_range_exactly(low, high):
    expected, at = [], low.replace(minute=0)
    while at < high:
        expected.append(at)
        at += timedelta(hours=1)
    assert hours_of(folder_patterns(low, high), low, high) == expected


def test_hour_folders_without_names(spark, tmp_path):
    base = str(tmp_path / "land ing")
    for n, hour in enumerate(["2024/01/01/22", "2024/01/01/23", "2024/01/02/00", "2024/02/01/05"]):
        spark.range(n, n + 1).toDF("i").write.parquet(f"{base}/{hour}")
    got = read_hours(spark, base, ROW, datetime(2024, 1, 1, 23), datetime(2024, 2, 2))
    assert sorted((r.i, r.yyyy, r.mm, r.dd, r.hh) for r in got.collect()) == [(1, 2024, 1, 1, 23), (2, 2024, 1, 2, 0), (3, 2024, 2, 1, 5)]
    none = read_hours(spark, base, ROW, datetime(2030, 1, 1), datetime(2030, 1, 2))
    assert none.isEmpty() and none.columns == ["i", "yyyy", "mm", "dd", "hh"]
    assert with_source_file(spark.read.parquet(f"{base}/2024/01/01/22")).first().src.endswith(".parquet")


def test_run_log_folders(spark, tmp_path):
    base = str(tmp_path / "logs" / "cron-batch")
    row = logs.run_status_row(run_id="abc", job="daily job", exit_code=0, started_at=datetime(2024, 1, 2, 3), ended_at=datetime(2024, 1, 2, 3, 1),
                              pg_table="t", prod_table="p")
    logs.write_run_status(spark, f"{base}/db1", row)
    late = logs.write_run_status(spark, f"{base}/db1", {**row, "run_id": "late", "started_at_utc": "2024-01-03T00:00:00Z"})
    assert Path(late).is_file() and json.loads(Path(late).read_text()) == {**row, "run_id": "late", "started_at_utc": "2024-01-03T00:00:00Z"}
    assert list(json.loads(Path(late).read_text())) == RUN_STATUS.names
    logs.write_run_status(spark, f"{base}/db1", {**row, "run_id": "late", "started_at_utc": "2024-01-03T00:00:00Z"})  # replaced, not doubled
    lines = read_run_logs(spark, base, ["db1", "absent"], "daily job", datetime(2024, 1, 2), datetime(2024, 1, 3))
    one = lines.first()
    assert lines.count() == len(RUN_STATUS) + 2 and (one.system, one.job, one.year, one.month, one.day) == ("db1", "daily job", 2024, 1, 2)
    run = extract_runs(lines).first()
    assert (run.run_id, run.table_name, run.duration_seconds, run.source_name, run.started_at_wib) == (
        "abc", "t", 60, "db1", "2024-01-02T10:00:00+0700")
    assert read_run_logs(spark, base, ["db1"], ["nope"], datetime(2024, 1, 2), datetime(2024, 1, 3)).isEmpty()
    with pytest.raises(ValueError, match="job"):
        read_run_logs(spark, base, ["db1"], "", datetime(2024, 1, 2), datetime(2024, 1, 3))
    with pytest.raises(ValueError, match="system"):
        read_run_logs(spark, base, [], "j", datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert read_run_status(spark, base).schema == RUN_STATUS
    assert sorted(r.run_id for r in read_run_status(spark, base).collect()) == ["abc", "late"]


def test_pretty_printed_status_documents(spark, tmp_path):
    (tmp_path / "status.json").write_text('{\n  "run_id": "r",\n  "exit_code": 3,\n  "status": "ERROR"\n}\n')
    row = read_run_status(spark, str(tmp_path)).first()
    assert (row.run_id, row.exit_code, row.status, row.host) == ("r", 3, "ERROR", None)


def test_csv_log_keeps_text_partitions_and_quotes(spark, tmp_path):
    rows = [("db, \"one\"", "t", "2024-01-01T07:00:00+07:00", "2024-01-01T07:00:05+07:00", "OK", 5, "2024-01-01", "07", "db one")]
    df = spark.createDataFrame(rows, "DATABASE_SOURCE string, TABLE_NAME string, RUN_START_ISO string, RUN_END_ISO string, "
                                     "JOB_STATUS string, TOTAL_DURATIONS int, dt string, hour string, source string")
    logs.write_dq_run_log(df, str(tmp_path / "log"))
    logs.write_dq_run_log(df, str(tmp_path / "log"))
    back = read_dq_run_log(spark, str(tmp_path / "log"))
    assert back.count() == 2
    assert back.first() == df.first()
    assert back.filter("hour = '07'").count() == 2


def test_staging_modes(spark, tmp_path):
    path = str(tmp_path / "s")
    first = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5)], "id int, p string, x double")
    write_staging(first, path, partitions=["p"])
    write_staging(spark.createDataFrame([(9, "b", 9.5)], "id int, p string, x double"), path, partitions=["p"])
    assert sorted((r.id, r.p, r.x) for r in read_staging(spark, path).collect()) == [("1", "a", "1.5"), ("9", "b", "9.5")]
    write_staging(first.withColumn("more", F.lit(True)), path, partitions=["p"], mode="append")
    grown = read_staging(spark, path)
    assert grown.count() == 4 and grown.filter("more = 'true'").count() == 2
    write_staging(first.limit(1), path, partitions=["p"], mode="overwrite")
    assert read_staging(spark, path).count() == 1
    with pytest.raises(ValueError, match="mode"):
        write_staging(first, path, mode="replace")
    frame = staging_frame(first, partitions=["load_date"], types={"X": "double"}, as_of=datetime(2024, 1, 1, 23, 59))
    assert [(f.name, f.dataType.simpleString()) for f in frame.schema] == [
        ("id", "string"), ("p", "string"), ("x", "double"), ("load_date", "string")]
    assert frame.first().load_date == "2024-01-01"
    assert staging_frame(first, force_text=False, types={"id": "bigint"}).schema["id"].dataType == T.LongType()


def test_staging_table_registration_and_drop(spark, tmp_path):
    path = str(tmp_path / "stg")
    df = spark.createDataFrame([(1, "a")], "id int, p string")
    write_staging(df, path, table="stg_t", partitions=["p"])
    assert relations.table_columns(spark, "stg_t") == ["id", "p"]
    write_staging(df.withColumn("z", F.lit(1)), path, table="stg_t", partitions=["p"])
    assert "z" in relations.table_types(spark, "stg_t") and spark.table("stg_t").count() == 1
    assert table_location(spark, "stg_t").rstrip("/").endswith("stg")
    assert drop_staging(spark, "stg_t") is None
    assert not spark.catalog.tableExists("stg_t") and read_staging(spark, path).count() == 1
    write_staging(df, path, table="stg_t", mode="overwrite")
    assert drop_staging(spark, "stg_t", purge=True) is None
    assert not spark.catalog.tableExists("stg_t") and spark.read.parquet(path).isEmpty()
    assert drop_staging(spark, "stg_t") is None
    assert drop_staging(spark, "no such name!") is not None


def test_staging_schema_grows_and_widens(spark, tmp_path):
    path = str(tmp_path / "grow")

    def load(row, schema, **options):
        write_staging(spark.createDataFrame([row], schema), path, table="stg_grow", partitions=["p"], force_text=False, **options)
        return {r.p: r.asDict() for r in spark.table("stg_grow").collect()}

    load((1, 1.5, "a"), "id int, x float, p string")
    load((2, 2.5, "more", "b"), "id int, x float, y string, p string")
    got = load((2 ** 40, 3.5, "c"), "id bigint, x double, p string")
    assert got == {"a": {"id": 1, "x": 1.5, "y": None, "p": "a"}, "b": {"id": 2, "x": 2.5, "y": "more", "p": "b"}, "c": {"id": 2 ** 40, "x": 3.5, "y": None, "p": "c"}}
    assert {n: t.simpleString() for n, t in relations.table_types(spark, "stg_grow").items()} == {"id": "bigint", "x": "double", "y": "string", "p": "string"}
    got = load((7, "narrow", "a"), "ID short, y string, p string")  # a narrower load is read as the entry says
    assert got["a"] == {"id": 7, "x": None, "y": "narrow", "p": "a"} and set(got) == {"a", "b", "c"}
    with pytest.raises(ValueError, match="cannot"):
        load(("text", "a"), "id string, p string")
    with pytest.raises(ValueError, match="schema_evolution"):
        load((1, 2, "a"), "id int, z int, p string", schema_evolution=False)
    assert set(load((1, "q"), "id string, p string".replace("string,", "int,"), mode="overwrite")) == {"q"}  # a whole overwrite starts anew
    assert relations.table_columns(spark, "stg_grow") == ["id", "p"]


def test_only_written_partitions_are_registered(spark, tmp_path):
    path, df = str(tmp_path / "reg"), spark.createDataFrame([(1, "a")], "id int, p string")
    write_staging(df, path, table="stg_reg", partitions=["p"])
    df.withColumn("p", F.lit("stray")).write.mode("append").partitionBy("p").parquet(path)
    write_staging(df.withColumn("p", F.lit("b")), path, table="stg_reg", partitions=["p"])
    assert [r[0] for r in spark.sql("SHOW PARTITIONS stg_reg").collect()] == ["p=a", "p=b"]
    write_staging(df.withColumn("p", F.lit("a")), path, table="stg_reg", partitions=["p"], mode="append")
    assert sorted((r.id, r.p) for r in spark.table("stg_reg").collect()) == [("1", "a"), ("1", "a"), ("1", "b")]


def test_silver_versions(spark, tmp_path):
    with pytest.raises(ValueError, match="not found"):
        silver.assert_database(spark, "nowhere")
    silver.ensure_database(spark, "sv", str(tmp_path))
    silver.ensure_database(spark, "sv")
    silver.assert_database(spark, "sv")
    silver.create_table(spark, "sv.t", T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())]), str(tmp_path / "t"))
    assert spark.table("sv.t").isEmpty()
    silver.merge_table(spark, "sv.t", spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string"), MergeRules(keys="id"))
    old = spark.table("sv.t")
    silver.merge_table(spark, "sv.t", spark.createDataFrame([("2", "B"), ("3", "c")], "id string, v string"), MergeRules(keys="id"), version="2")
    assert sorted(tuple(r) for r in spark.table("sv.t").collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert silver.current_version(spark, "sv.t") == "2"
    assert sorted(tuple(r) for r in old.collect()) in ([(1, "a"), (2, "b")], [(1, "a"), (2, "B"), (3, "c")])
    silver.create_dq_result_table(spark, "sv.dq", str(tmp_path / "dq"))
    assert [f.dataType for f in spark.table("sv.dq").schema] == [f.dataType for f in DQ_RESULT]
    files = [p.name for p in (tmp_path / "t").rglob("*.parquet")]
    assert files and all(".zstd." in name for name in files)


def _above(plan, leaf):
    """The steps above the first ``leaf`` of a plan's text."""
    lines = [(len(x) - len(x.lstrip(" :+-*")), x.lstrip(" :+-*")) for x in plan.splitlines()]
    at = next(i for i, (_, x) in enumerate(lines) if leaf in x)
    depth, found = lines[at][0], []
    for d, x in reversed(lines[:at]):
        if d < depth:
            depth = d
            found.append(x.split(") ", 1)[1] if x.startswith("(") else x)
    return found


def _read_buckets(spark, table):
    """(bucket of the file's name, bucket of the row's key) of all rows."""
    number = silver.bucket_layout(spark, table).number
    found = spark.table(table).select(F.regexp_extract(F.col("_metadata.file_name"), r"_([0-9]{5})[.]", 1).cast("int"), F.pmod(F.hash("id"), F.lit(number)))
    return [tuple(r) for r in found.collect()]


@pytest.mark.parametrize("partitions", [(), ("p",)])
def test_buckets_survive_merges(spark, tmp_path, partitions):
    name = f"bucketed_{len(partitions)}"
    rows = spark.range(200).select("id", F.lit("t").alias("v"), (F.col("id") % 3).cast("string").alias("p"))
    silver.create_table(spark, name, rows.schema, str(tmp_path / "t"), partitions=partitions, buckets=silver.Buckets(("id",), 6))
    assert silver.bucket_layout(spark, name) == silver.Buckets(("id",), 6)
    before = len(spark.catalog.listTables())
    silver.merge_table(spark, name, rows, MergeRules(keys="id"))
    fresh = spark.range(150, 260).select("id", F.lit("s").alias("v"), (F.col("id") % 4).cast("string").alias("p"))
    fresh = fresh.unionByName(spark.createDataFrame([(None, "null", "0")], "id long, v string, p string"))
    silver.merge_table(spark, name, fresh, MergeRules(keys="id"))
    assert len(spark.catalog.listTables()) == before  # the entries used for writing are gone
    want = {(i, "t", str(i % 3)) for i in range(150)} | {(i, "s", str(i % 4)) for i in range(150, 260)}
    got = [tuple(r) for r in spark.table(name).select("id", "v", "p").collect()]
    assert len(got) == len(want) + 1 and set(got) == want | {(None, "null", "0")}
    assert all(of_file == of_key for of_file, of_key in _read_buckets(spark, name))
    # repeated source rows, and the other plan, whose rows are dealt again
    silver.merge_table(spark, name, fresh.filter("id < 160").withColumn("v", F.lit("r")), MergeRules(keys="id", strategy="lookup"))
    assert spark.table(name).filter("v = 'r'").count() == 10 and spark.table(name).count() == len(got)
    assert all(of_file == of_key for of_file, of_key in _read_buckets(spark, name))


def test_a_bucketed_target_is_not_shuffled(spark, tmp_path):
    rows = spark.range(5000).select("id", F.lit("t").alias("v"))
    for name, buckets in (("dealt", silver.Buckets(("id",), 6)), ("undealt", None), ("elsewhere", silver.Buckets(("v",), 6))):
        silver.create_table(spark, name, rows.schema, str(tmp_path / name), buckets=buckets)
        silver.publish_version(spark, name, rows)
    source = spark.range(4000, 6000).select("id", F.lit("s").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name, shuffles in (("dealt", 0), ("undealt", 1), ("elsewhere", 1)):
            merged = merge_upsert(spark.table(name), source, silver.merged_in_buckets(MergeRules(keys="id"), silver.bucket_layout(spark, name)))
            above = _above(merged._jdf.queryExecution().executedPlan().toString(), "FileScan")
            assert sum(step.startswith("SortMergeJoin") for step in above) == 1
            assert sum(step.startswith("Exchange") for step in above) == shuffles, (name, above)
            assert merged.count() == 6000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert silver.merged_in_buckets(MergeRules(keys="id", strategy="lookup"), silver.bucket_layout(spark, "dealt")).strategy == "lookup"
    # a merge writes one file a bucket, without another shuffle
    silver.merge_table(spark, "dealt", source, MergeRules(keys="id"))
    files = [r[0] for r in spark.table("dealt").select("_metadata.file_name").distinct().collect()]
    assert len(files) == 6 and spark.table("dealt").count() == 6000


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("day", T.StringType())])
    silver.create_table(spark, "daily", schema, str(tmp_path / "d"), partitions=["day"])
    spark.createDataFrame([(i, "old", f"d{i % 3}") for i in range(9)], schema).write.insertInto("daily")
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "d").rglob("day=d[12]/*.parquet")}
    silver.merge_table(spark, "daily", spark.createDataFrame([("0", "new", "d0"), ("30", "new", "d0"), ("31", "new", "d9")],
                                                             "id string, v string, day string"), MergeRules(keys="id"), partitions=["day"])
    got = sorted(tuple(r) for r in spark.table("daily").collect())
    assert got == sorted([(i, "new" if i == 0 else "old", f"d{i % 3}") for i in range(9)] + [(30, "new", "d0"), (31, "new", "d9")])
    assert files and files == {p: p.stat().st_mtime_ns for p in (tmp_path / "d").rglob("day=d[12]/*.parquet")}
    some = spark.createDataFrame([(f"d{i}",) for i in range(2500)], "day string")
    plan = silver.touched_partitions(spark.table("daily"), some, ["day"])._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError, match="partitioned by"):
        silver.merge_table(spark, "daily", some, MergeRules(keys="id"), partitions=["v"])


def daily(spark, tmp_path, name):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("day", T.StringType())])
    silver.create_table(spark, name, schema, str(tmp_path / name), partitions=["day"])
    spark.createDataFrame([(i, "old", f"d{i % 3}") for i in range(9)], schema).write.insertInto(name)
    return lambda: sorted(tuple(r) for r in spark.table(name).collect())


CHANGES = "id string, v string, day string, __op string"


def test_keys_move_between_partitions(spark, tmp_path):
    rows = daily(spark, tmp_path, "moving")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "moving").rglob("*.parquet")}
    move = spark.createDataFrame([("1", "moved", "d2", "u"), ("4", "moved", None, "u"), ("20", "new", "it's/new", "c")], CHANGES)
    with pytest.raises(ValueError, match="another partition"):
        silver.merge_partitions(spark, "moving", move, MergeRules(keys="id", op=None), moved="error")
    with pytest.raises(ValueError, match="moved"):
        silver.merge_partitions(spark, "moving", move, MergeRules(keys="id", op=None), moved="perhaps")
    silver.merge_table(spark, "moving", move, MergeRules(keys="id", op=None))
    want = [(i, "old", f"d{i % 3}") for i in range(9) if i not in (1, 4)] + [(1, "moved", "d2"), (4, "moved", None), (20, "new", "it's/new")]
    assert sorted(rows(), key=str) == sorted(want, key=str)
    assert before == {p: p.stat().st_mtime_ns for p in before}  # a reader that has planned keeps its files
    assert "day=d0" not in {p.parent.name for p in (tmp_path / "moving").glob("merge=*/*/*.parquet")}
    silver.merge_partitions(spark, "moving", spark.createDataFrame([("1", "twice", "d0", "u")], CHANGES), MergeRules(keys="id", op=None), moved="never")
    assert [r[1] for r in rows() if r[0] == 1] == ["twice", "moved"] or [r[1] for r in rows() if r[0] == 1] == ["moved", "twice"]


def test_deletes_empty_a_partition(spark, tmp_path):
    rows = daily(spark, tmp_path, "shrinking")
    rules = MergeRules(keys="id", op=None, apply_deletes=True)
    # deletes may know their key alone
    gone = spark.createDataFrame([("0", None, None, "d"), ("3", None, "d0", "d"), ("6", "x", "d0", "d"), ("1", None, None, "d"), ("77", None, None, "d")], CHANGES)
    silver.merge_table(spark, "shrinking", gone, rules)
    assert rows() == [(i, "old", f"d{i % 3}") for i in range(9) if i not in (0, 3, 6, 1)]
    assert [r[0] for r in spark.sql("SHOW PARTITIONS shrinking").collect()] == ["day=d1", "day=d2"]
    silver.merge_table(spark, "shrinking", spark.createDataFrame([(str(i), None, None, "d") for i in range(9)], CHANGES), rules)
    assert rows() == [] and spark.sql("SHOW PARTITIONS shrinking").isEmpty()
    silver.merge_table(spark, "shrinking", spark.createDataFrame([("5", "back", "d2", "c")], CHANGES), rules)
    assert rows() == [(5, "back", "d2")]
    silver.merge_table(spark, "shrinking", spark.createDataFrame([], CHANGES), rules)
    assert rows() == [(5, "back", "d2")]


def test_a_reader_sees_a_partition_before_or_after(spark, tmp_path):
    rows = daily(spark, tmp_path, "watched")
    states = {tuple(rows())}
    seen, problems, done = [], [], threading.Event()

    def watch():
        while not done.is_set():
            try:
                seen.append(tuple(sorted(tuple(r) for r in spark.table("watched").filter("day = 'd0'").collect())))
            except Exception as problem:  # noqa: BLE001 - shown by the assertion below
                problems.append(problem)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        for step in ([("0", "a", "d0", "u"), ("30", "a", "d0", "c")], [("0", None, "d0", "d"), ("30", "b", "d0", "u")], [("30", None, None, "d"), ("3", None, None, "d"), ("6", None, None, "d")]):
            silver.merge_table(spark, "watched", spark.createDataFrame(step, CHANGES), MergeRules(keys="id", op=None, apply_deletes=True))
            states.add(tuple(rows()))
    finally:
        done.set()
        watcher.join()
    assert not problems and seen
    assert set(seen) <= {tuple(r for r in state if r[2] == "d0") for state in states}


def test_a_second_writer_of_a_partition_loses_nothing(spark, tmp_path, monkeypatch):
    rows = daily(spark, tmp_path, "shared_days")
    rules, switch = MergeRules(keys="id", op=None), silver._switch_partitions
    others = [("40", "other", "d0"), ("41", "other", "d9"), ("3", "other", "d0")]

    def beaten(*args):
        monkeypatch.setattr(silver, "_switch_partitions", switch)
        for other in others:  # comes between the plan and the switch
            silver.merge_table(spark, "shared_days", spark.createDataFrame([(*other, "u")], CHANGES), rules)
        switch(*args)

    monkeypatch.setattr(silver, "_switch_partitions", beaten)
    with pytest.raises(silver.TableMoved):
        silver.merge_partitions(spark, "shared_days", spark.createDataFrame([("0", "mine", "d0", "u")], CHANGES), rules)
    assert [r for r in rows() if r[1] == "mine"] == []
    monkeypatch.setattr(silver, "_switch_partitions", beaten)
    silver.merge_table(spark, "shared_days", spark.createDataFrame([("0", "mine", "d0", "u"), ("50", "mine", "d9", "u")], CHANGES), rules)
    assert {r[0] for r in rows() if r[1] == "mine"} == {0, 50} and {r[0] for r in rows() if r[1] == "other"} == {40, 41, 3}
    # a plain insert counts as another writer, too
    def appended(*args):
        monkeypatch.setattr(silver, "_switch_partitions", switch)
        spark.createDataFrame([(60, "plain", "d0")], "id long, v string, day string").write.insertInto("shared_days")
        switch(*args)

    monkeypatch.setattr(silver, "_switch_partitions", appended)
    silver.merge_table(spark, "shared_days", spark.createDataFrame([("0", "again", "d0", "u")], CHANGES), rules)
    assert {r[1] for r in rows() if r[0] in (0, 60)} == {"again", "plain"}


def test_home_lookup_is_pruned_by_the_keys(spark, tmp_path):
    daily(spark, tmp_path, "pruned")
    some = spark.createDataFrame([(3, "d1"), (4, "d1")], "id long, day string")
    plan = silver.home_partitions(spark.table("pruned"), some, ["id"], ["day"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,3)" in plan and "LessThanOrEqual(id,4)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_latest_view_follows_the_table(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("n", T.LongType())])
    silver.create_table(spark, "log_rows", schema, str(tmp_path / "l"))
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], schema).write.insertInto("log_rows")
    silver.create_latest_view(spark, "log_latest", "log_rows", ["id"], ["n"])
    assert sorted(tuple(r) for r in spark.table("log_latest").collect()) == [(1, "b", 2), (2, "c", 1)]
    spark.createDataFrame([(2, "d", 5)], schema).write.insertInto("log_rows")
    assert sorted(r.v for r in spark.table("log_latest").collect()) == ["b", "d"]
    assert spark.table("log_latest")._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_relations(spark):
    assert relations.table_name("t", "db", "cat") == "`cat`.`db`.`t`" and relations.table_name("a.b", "db") == "`a`.`b`"
    spark.range(3).createOrReplaceTempView("three")
    assert relations.read_table(spark, "three").count() == 3
    got = relations.query(spark, 'SELECT id AS `Row Id`, 1 FROM {src} WHERE id > ?', "[0]", src=spark.range(3))
    assert got.columns == ["row_id", "_1"] and got.count() == 2
    assert relations.query(spark, "SELECT 1 AS x").count() == 1
    with pytest.raises(ValueError, match="JSON array"):
        relations.query(spark, "SELECT 1", '{"a": 1}')
    with pytest.raises(ValueError, match="bounds"):
        relations.read_jdbc(spark, "jdbc:none", "SELECT 1", split_column="id")


def test_session_helpers(spark):
    small = spark.range(10)
    assert estimated_bytes(small) == 80 and fits_broadcast(small) and not fits_broadcast(small, 0)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
