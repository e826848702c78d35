"""Source and sink round trips, streams and whole jobs.

These write to a fresh folder below the shared scratch folder and return what is read back.
"""

from __future__ import annotations

import uuid
import warnings
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casting import cast_to_schema
from tidemark.functions.clock import WIB, to_wib
from tidemark.operators.latest import current_state
from tidemark.operators.predicates import select_changes
from tidemark.operators.reconcile import CheckSpec
from tidemark.operators.runlog import dq_run_report, run_report
from tidemark.operators.upsert import MergeRules
from tidemark.plans.jobs import BackfillSpec, JobSpec, backfill, full_run, reconcile
from tidemark.plans.slices import backfill_in_slices
from tidemark.schemas import META_STRUCT, RUN_STATUS, with_columns
from tidemark.session import scratch_path
from tidemark.sinks import logs as log_sinks
from tidemark.sinks import silver as silver_sinks
from tidemark.sinks.staging import read_staging, write_staging
from tidemark.sources.changes import json_value, read_change_files
from tidemark.sources.logs import read_dq_run_log, read_run_status
from tidemark.sources.partitioned import read_hours, read_run_logs
from tidemark.streaming import changes as stream

from .checking import HIGH, LOW, RECONCILE_SQL
from .checking import _RATES as RATES
from .inputs import (
    AS_OF, DB_SOURCE, cdc_changes, dq_run_log, padded, plain, run_log_lines, runs, silver_events, silver_orders, spread, stg_orders,
    table, typed_changes, with_inputs,
)
from .merging import BACKFILL_HIGH, BACKFILL_LOW, BACKFILL_RANGE_SQL, STAGED_TYPES, backfill_source, merge_sql, order_rules
from .registry import ORACLES, query


def _unique(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


# --- staging -----------------------------------------------------------------------------------

@query(with_inputs("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, created_at, updated_at "
                   "FROM typed_changes", "typed_changes"))
def staging_roundtrip(spark, sf):
    path = scratch_path(spark, "staging")
    write_staging(typed_changes(spark, sf), path, mode="overwrite")
    return plain(cast_to_schema(read_staging(spark, path), STAGED_TYPES))


@query("""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, '2024-02-01' AS load_date FROM events""")
def staging_load_date(spark, sf):
    path = scratch_path(spark, "staging")
    write_staging(table(spark, sf, "events").select("event_id", "user_id", "event_type"), path, partitions=["load_date"], as_of=AS_OF)
    return read_staging(spark, path).select("event_id", "user_id", "event_type", "load_date")


@query("SELECT CAST(event_id AS BIGINT) AS event_id, value, CAST(user_id AS VARCHAR) AS user_id, event_type FROM events")
def staging_dtype_override(spark, sf):
    path = scratch_path(spark, "staging")
    write_staging(table(spark, sf, "events").select("event_id", "value", "user_id", "event_type"), path, mode="append",
                  types={"event_id": "bigint", "value": "double"})
    return read_staging(spark, path)


@query("""SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type IN ('click', 'view') THEN 'second' ELSE 'first' END AS load,
  event_type FROM events""")
def partition_overwrite(spark, sf):
    """A second load replaces only the partitions it has rows for."""
    path = scratch_path(spark, "staging")
    events = table(spark, sf, "events").select("event_id", "event_type")
    write_staging(events.withColumn("load", F.lit("first")), path, partitions=["event_type"])
    again = events.filter(F.col("event_type").isin("click", "view")).withColumn("load", F.lit("second"))
    write_staging(again, path, partitions=["event_type"])
    return read_staging(spark, path).select("event_id", "load", "event_type")


# --- folder and log scans ----------------------------------------------------------------------

EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                      T.StructField("event_type", T.StringType())])


@query("""SELECT event_id, ts, event_type, CAST(year(ts) AS INTEGER) AS yyyy, CAST(month(ts) AS INTEGER) AS mm,
  CAST(day(ts) AS INTEGER) AS dd, CAST(hour(ts) AS INTEGER) AS hh FROM events
WHERE ts >= TIMESTAMP '2024-01-05 07:00:00' AND ts < TIMESTAMP '2024-01-20 18:00:00'""")
def projected_scan(spark, sf):
    """Hour folders of a time range, found without listing the others."""
    path = scratch_path(spark, "landing")
    landed = table(spark, sf, "events").select("event_id", "ts", "event_type", F.year("ts").cast("string").alias("yyyy"), *(
        padded(part("ts")).alias(n) for n, part in (("mm", F.month), ("dd", F.dayofmonth), ("hh", F.hour))))
    spread(landed, "yyyy", "mm", "dd", "hh").write.partitionBy("yyyy", "mm", "dd", "hh").parquet(path)
    return read_hours(spark, path, EVENT, datetime(2024, 1, 5, 7), datetime(2024, 1, 20, 18), prefixes=("yyyy=", "mm=", "dd=", "hh="))


@query(with_inputs("""SELECT concat('system=', system) AS system, concat('job=', job) AS job, year, month, day, line FROM run_log_lines
WHERE system IN ('db0', 'db2') AND job IN ('click', 'view') AND year = 2024 AND month = 1 AND day BETWEEN 3 AND 20""", "run_log_lines"))
def projected_text_scan(spark, sf):
    path = scratch_path(spark, "logs") + "/logs/cron-batch"
    parts = ["system", "job", "year", "month", "day"]
    lines = run_log_lines(spark, sf).select("line", "system", "job", F.col("year").cast("string").alias("year"),
                                            padded(F.col("month")).alias("month"), padded(F.col("day")).alias("day"))
    spread(lines, *parts).write.partitionBy(*parts).text(path)
    return read_run_logs(spark, path, ["system=db0", "system=db2"], ["job=click", "job=view"], datetime(2024, 1, 3),
                         datetime(2024, 1, 21), prefixes=("year=", "month=", "day=")).drop("src")


@query(with_inputs('SELECT dt, source, "TABLE_NAME" AS table_name, ' + RATES.format(
    good="\"JOB_STATUS\" = 'OK'", bad="\"JOB_STATUS\" = 'ERR'") + " FROM dq_run_log GROUP BY 1, 2, 3", "dq_run_log"))
def csv_log_roundtrip(spark, sf):
    path = scratch_path(spark, "dq-log")
    log_sinks.write_dq_run_log(spread(dq_run_log(spark, sf), "dt", "hour", "source"), path)
    return dq_run_report(read_dq_run_log(spark, path))


@query(with_inputs("""SELECT run_id, job, exit_code, status, strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') AS started_at_utc,
  strftime(ended_at + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S+0700') AS ended_at_wib, duration_seconds FROM runs""", "runs"))
def status_json_roundtrip(spark, sf):
    path = scratch_path(spark, "status")
    utc, wib = "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'+0700'"
    made = {
        "started_at_utc": F.date_format("started_at", utc), "ended_at_utc": F.date_format("ended_at", utc),
        "started_at_wib": F.date_format(to_wib(F.col("started_at")), wib), "ended_at_wib": F.date_format(to_wib(F.col("ended_at")), wib),
        "timezone_wib": F.lit(WIB)}
    r = runs(spark, sf)
    status = r.select(*(
        made.get(f.name, F.col(f.name) if f.name in r.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN_STATUS.fields))
    log_sinks.write_run_statuses(status, path)
    return read_run_status(spark, path, multi_line=False).select(
        "run_id", "job", "exit_code", "status", "started_at_utc", "ended_at_wib", "duration_seconds")


# --- tables ------------------------------------------------------------------------------------

def silver_table(spark: SparkSession, frame: DataFrame, label: str, partitions: tuple[str, ...] = (),
                 buckets: silver_sinks.Buckets | None = None) -> str:
    """A catalog table holding ``frame``: as its first version, or in partitions."""
    home, database = scratch_path(spark, label), _unique("tidemark")
    silver_sinks.ensure_database(spark, database, home)
    silver_sinks.assert_database(spark, database)
    name = f"{database}.{label}"
    silver_sinks.create_table(spark, name, frame.schema, f"{home}/{label}", partitions=partitions, buckets=buckets)
    if partitions:
        spread(frame, *partitions).select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    else:
        silver_sinks.publish_version(spark, name, frame)
    return name


@query(merge_sql())
def table_lifecycle(spark, sf):
    """Create, load, merge and republish a silver table; the view reads the newest version."""
    name = silver_table(spark, silver_orders(spark, sf), "orders")
    silver_sinks.merge_table(spark, name, stg_orders(spark, sf), order_rules())
    view = _unique("silver_view")
    silver_sinks.create_view(spark, view, spark.table(name))
    return plain(spark.table(view))


@query(merge_sql())
def merge_bucketed(spark, sf):
    """Merge into a table in buckets of its key: the table is not shuffled, and stays in its buckets."""
    orders = silver_orders(spark, sf)
    name = silver_table(spark, orders, "orders", buckets=silver_sinks.Buckets(("o_orderkey",), 8))
    silver_sinks.merge_table(spark, name, stg_orders(spark, sf), order_rules())
    return plain(spark.table(name))


@query(with_inputs("""SELECT coalesce(s.event_id, e.event_id) AS event_id, coalesce(s.kind, e.event_type) AS kind,
  coalesce(s.day, strftime(e.ts, '%Y-%m-%d')) AS day FROM (SELECT * FROM events WHERE value <= 150.0) e
FULL JOIN (SELECT event_id, upper(event_type) AS kind, strftime(ts, '%Y-%m-%d') AS day FROM events
  WHERE ts >= TIMESTAMP '2024-01-20') s ON s.event_id = e.event_id""", "silver_events"))
def merge_touched_partitions(spark, sf):
    """Merge the last days into a table partitioned by day; earlier days are neither read nor written."""
    home, name = scratch_path(spark, "daily"), f"daily_{uuid.uuid4().hex[:12]}"
    events = table(spark, sf, "events").select("event_id", F.col("event_type").alias("kind"), "ts", "value",
                                               F.date_format("ts", "yyyy-MM-dd").alias("day"))
    first = events.filter("value <= 150.0").select("event_id", "kind", "day")
    silver_sinks.create_table(spark, name, first.schema, home, partitions=["day"])
    spread(first, "day").write.mode("overwrite").insertInto(name)
    recent = events.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")).select("event_id", F.upper("kind").alias("kind"), "day")
    silver_sinks.merge_table(spark, name, recent, MergeRules(keys="event_id"), partitions=["day"])
    return spark.table(name)


def _daily(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Events in a table partitioned by day, without those of large value, and all events."""
    events = table(spark, sf, "events").select("event_id", F.col("event_type").alias("kind"), "ts", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return silver_table(spark, events.filter("value <= 150.0").select("event_id", "kind", "day"), "daily", ("day",)), events


@query("""SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN upper(event_type) ELSE event_type END AS kind,
  strftime(CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN ts - INTERVAL 9 DAY ELSE ts END, '%Y-%m-%d') AS day FROM events
WHERE value <= 150.0 OR ts >= TIMESTAMP '2024-01-20'""")
def merge_moved_keys(spark, sf):
    """Rows whose partition value changes leave their old partitions; those of the last days end empty."""
    name, events = _daily(spark, sf)
    moved = events.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")).select(
        "event_id", F.upper("kind").alias("kind"), F.date_format(F.col("ts") - F.expr("interval 9 days"), "yyyy-MM-dd").alias("day"))
    silver_sinks.merge_table(spark, name, moved, MergeRules(keys="event_id"))
    return spark.table(name)


@query("""SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-25' THEN upper(event_type) ELSE event_type END AS kind, strftime(ts, '%Y-%m-%d') AS day,
  'day=' || strftime(ts, '%Y-%m-%d') AS partition FROM events
WHERE ts >= TIMESTAMP '2024-01-25' OR (value <= 150.0 AND ts < TIMESTAMP '2024-01-20')""")
def merge_emptied_partitions(spark, sf):
    """Deletes that know their key alone remove whole days, updates in the same batch change others; emptied days leave the catalog."""
    name, events = _daily(spark, sf)
    recent = events.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    gone = F.col("day") < "2024-01-25"
    changes = recent.select("event_id", F.when(~gone, F.upper("kind")).alias("kind"), F.when(~gone, F.col("day")).alias("day"),
                            F.when(gone, "d").otherwise("u").alias("__op"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        silver_sinks.merge_table(spark, name, changes, MergeRules(keys="event_id", op=None, apply_deletes=True))
    listed = spark.sql(f"SHOW PARTITIONS {name}")
    return spark.table(name).join(listed, F.col("partition") == F.concat(F.lit("day="), "day"), "full")


@query("""SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN value END AS value,
  CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN user_id END AS user_id, strftime(ts, '%Y-%m') || CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 'c'
  WHEN ts >= TIMESTAMP '2024-01-10' THEN 'b' ELSE 'a' END AS load FROM events""")
def staging_schema_evolution(spark, sf):
    """Three loads, each with a column more and the last with a wider key, read back whole through the table."""
    path, name = scratch_path(spark, "staging"), _unique("stg_events")
    events = table(spark, sf, "events")
    steps = [("a", None, "2024-01-10", ["event_id", "event_type"], "int"), ("b", "2024-01-10", "2024-01-20", ["event_id", "event_type", "value"], "int"),
             ("c", "2024-01-20", None, ["event_id", "event_type", "user_id", "value"], "bigint")]
    for load, low, high, columns, kind in steps:
        rows = events
        if low:
            rows = rows.filter(F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
        if high:
            rows = rows.filter(F.col("ts") < F.lit(high).cast("timestamp_ntz"))
        write_staging(rows.select(*columns, F.concat(F.date_format("ts", "yyyy-MM"), F.lit(load)).alias("load")), path, table=name, partitions=["load"],
                      force_text=False, types={"event_id": kind})
    return spark.table(name)


# --- change streams ----------------------------------------------------------------------------

_STATE_SQL = """SELECT id, event_type, CAST(amount AS DOUBLE) AS amount, __op, __ts_ms, event_id FROM cdc_changes
QUALIFY row_number() OVER (PARTITION BY id ORDER BY __ts_ms DESC, event_id DESC) = 1"""
CHANGE = T.StructType([T.StructField("id", T.LongType()), T.StructField("event_type", T.StringType()),
                       T.StructField("amount", T.StringType()), T.StructField("event_id", T.LongType())])
ENVELOPE = T.StructType([T.StructField("before", CHANGE), T.StructField("after", CHANGE), T.StructField("op", T.StringType()),
                         T.StructField("ts_ms", T.LongType())])
RECORD_KEY = T.StructType([T.StructField("id", T.LongType())])
TOPIC = T.StructType([T.StructField("table", T.StringType()), T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def _typed(changes: DataFrame) -> DataFrame:
    return stream.decode_changes(changes, {"amount": T.DecimalType(12, 2)})


def _enveloped(topic: DataFrame) -> DataFrame:
    return topic.filter(F.col("table") == "public.users").withColumns(
        {"key": json_value(F.col("key"), RECORD_KEY), "value": json_value(F.col("value"), ENVELOPE)})


def topic_files(spark: SparkSession, sf: str, *, in_order: bool = False) -> str:
    """The change log as topic files: keyed JSON envelopes, deletes with a before-image only, and a tombstone after each."""
    path = scratch_path(spark, "topic")
    c = cdc_changes(spark, sf)
    image, gone = F.struct("id", "event_type", "amount", "event_id"), F.col("__op") == "d"
    envelope = F.to_json(F.struct(F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"), F.col("__op").alias("op"),
                                  F.unix_millis(F.col("__ts_ms").cast("timestamp")).alias("ts_ms")))
    copies = F.when(F.col("__op") == "d", F.array(envelope, F.lit(None).cast("string"))).otherwise(F.array(envelope))
    mixed = c.repartitionByRange(4, "__ts_ms") if in_order else c.repartition(4, "event_id")
    mixed.select(F.lit("public.users").alias("table"), F.to_json(F.struct("id")).alias("key"), F.explode(copies).alias("value")).write.option(
        "ignoreNullFields", False).json(path)
    return path


def flat_stream(spark: SparkSession, sf: str, *, in_order: bool = False, files_per_batch: int = 1) -> DataFrame:
    files = read_change_files(spark, topic_files(spark, sf, in_order=in_order), TOPIC, files_per_batch=files_per_batch)
    return select_changes(stream.flatten_changes(_enveloped(files), record_key="key", keys=["id"]))


_MS = "date_trunc('millisecond', __ts_ms)"


@query(with_inputs(_STATE_SQL, "cdc_changes"))
def cdc_current_state(spark, sf):
    return plain(_typed(current_state(cdc_changes(spark, sf), "id", sequence=["event_id"])))


@query(with_inputs(f"SELECT * FROM ({_STATE_SQL}) x WHERE __op <> 'd'", "cdc_changes"))
def cdc_live_view(spark, sf):
    """The latest-row view without deleted keys."""
    view = _unique("live")
    silver_sinks.create_view(spark, view, _typed(current_state(
        cdc_changes(spark, sf), "id", sequence=["event_id"], drop_deleted=True)))
    return plain(spark.sql(f"SELECT * FROM {view}"))


@query(with_inputs(f"SELECT id, event_type, CAST(amount AS DOUBLE) AS amount, event_id, __op, {_MS} AS __ts_ms FROM cdc_changes", "cdc_changes"))
def cdc_flatten(spark, sf):
    """Envelopes to flat change rows; tombstones go, deletes stay."""
    topic = spark.read.schema(TOPIC).json(topic_files(spark, sf))
    return plain(_typed(stream.flatten_changes(_enveloped(topic), record_key="key", keys=["id"])))


@query(with_inputs(f"""SELECT id, event_type, amount, event_id, __op, {_MS} AS __ts_ms, CAST(year(__ts_ms) AS INTEGER) AS yyyy,
  CAST(month(__ts_ms) AS INTEGER) AS mm, CAST(day(__ts_ms) AS INTEGER) AS dd, CAST(hour(__ts_ms) AS INTEGER) AS hh
FROM cdc_changes""", "cdc_changes"))
def stream_land_hourly(spark, sf):
    path = scratch_path(spark, "landing")
    changes = flat_stream(spark, sf, in_order=True, files_per_batch=2)
    stream.land_by_hour(changes, path, scratch_path(spark, "landing-state"), every=None).awaitTermination()
    folders = T.StructType([T.StructField(n, T.IntegerType()) for n in ("yyyy", "mm", "dd", "hh")])
    return spark.read.schema(with_columns(CHANGE, META_STRUCT, folders)).parquet(path)


@query(with_inputs(f"""SELECT id, event_type, CAST(amount AS DOUBLE) AS amount, event_id, __op, {_MS} AS __ts_ms FROM cdc_changes
QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_MS} DESC, event_id DESC) = 1""", "cdc_changes"))
def stream_upsert(spark, sf):
    """Micro-batches merged into a silver table, newest change per key kept whatever the arrival order."""
    changes = _typed(flat_stream(spark, sf))
    name = silver_table(spark, spark.createDataFrame([], changes.schema), "users")
    rules = MergeRules(keys="id", guard="__ts_ms", op=None, tiebreakers=["event_id"], created_col=None)
    stream.upsert_stream(changes, name, rules, scratch_path(spark, "users-state"), every=None).awaitTermination()
    return plain(spark.table(name))


@query(with_inputs(f"""SELECT id, event_type, CAST(amount AS DOUBLE) AS amount, event_id, __op, {_MS} AS __ts_ms FROM cdc_changes
QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_MS} DESC, event_id DESC) = 1""", "cdc_changes"))
def stream_upsert_new_checkpoint(spark, sf):
    """Two streams into one table whose checkpoint folders share their last name: the second loses no batch."""
    topics = [topic_files(spark, sf), scratch_path(spark, "topic")]
    halves = spark.read.schema(TOPIC).json(topics[0]).withColumn("late", F.pmod(F.xxhash64("key", "value"), F.lit(2)) == 1)
    inboxes = [scratch_path(spark, "inbox") for _ in range(2)]
    for late, inbox in enumerate(inboxes):
        halves.filter(F.col("late") == F.lit(bool(late))).drop("late").repartition(2).write.option("ignoreNullFields", False).json(inbox)
    name = None
    for inbox in inboxes:
        files = read_change_files(spark, inbox, TOPIC, files_per_batch=1)
        changes = _typed(select_changes(stream.flatten_changes(_enveloped(files), record_key="key", keys=["id"])))
        name = name or silver_table(spark, spark.createDataFrame([], changes.schema), "users")
        rules = MergeRules(keys="id", guard="__ts_ms", op=None, tiebreakers=["event_id"], created_col=None)
        stream.upsert_stream(changes, name, rules, scratch_path(spark, "state") + "/users", every=None).awaitTermination()
    return plain(spark.table(name))


@query(with_inputs(f"""SELECT id, event_type, CAST(amount AS DOUBLE) AS amount, event_id, __op, {_MS} AS __ts_ms FROM (
SELECT * FROM cdc_changes QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_MS} DESC, event_id DESC) = 1) x WHERE __op <> 'd'""", "cdc_changes"))
def stream_apply_deletes(spark, sf):
    """Deletes that carry a before-image or only the record key remove their rows from a loaded table."""
    changes = _typed(flat_stream(spark, sf, files_per_batch=100))
    first = cdc_changes(spark, sf).groupBy("id").agg(F.lit("loaded").alias("event_type"), F.lit(0).cast("decimal(12,2)").alias("amount"),
                                                     F.lit(-1).cast("bigint").alias("event_id"), F.lit("r").alias("__op"),
                                                     F.lit("2000-01-01").cast("timestamp_ntz").alias("__ts_ms"))
    name = silver_table(spark, first.select(*[F.col(f.name).cast(f.dataType) for f in changes.schema.fields]), "users")
    rules = MergeRules(keys="id", guard="__ts_ms", op=None, tiebreakers=["event_id"], created_col=None, apply_deletes=True)
    stream.upsert_stream(changes, name, rules, scratch_path(spark, "users-state"), every=None).awaitTermination()
    return plain(spark.table(name))


@query(with_inputs(f"""SELECT id, event_type, amount, event_id, __op, {_MS} AS __ts_ms, CAST(year(__ts_ms) AS INTEGER) AS yyyy,
  CAST(month(__ts_ms) AS INTEGER) AS mm, CAST(day(__ts_ms) AS INTEGER) AS dd, CAST(hour(__ts_ms) AS INTEGER) AS hh
FROM cdc_changes WHERE __ts_ms >= TIMESTAMP '2024-01-05 07:00:00' AND __ts_ms < TIMESTAMP '2024-01-20 18:00:00'""", "cdc_changes"))
def landed_range_scan(spark, sf):
    """Hour folders landed by a stream, read back for a time range."""
    path = scratch_path(spark, "landing")
    changes = flat_stream(spark, sf, in_order=True, files_per_batch=2)
    stream.land_by_hour(changes, path, scratch_path(spark, "landing-state"), every=None).awaitTermination()
    return read_hours(spark, path, with_columns(CHANGE, META_STRUCT), datetime(2024, 1, 5, 7), datetime(2024, 1, 20, 18),
                      prefixes=("yyyy=", "mm=", "dd=", "hh="))


@query("SELECT date_trunc('hour', ts) AS slot, count(*) AS total_rows FROM events GROUP BY 1")
def stream_hourly_counts(spark, sf):
    source, out = scratch_path(spark, "events"), scratch_path(spark, "counts")
    table(spark, sf, "events").select("event_id", "ts").repartition(3).write.parquet(source)
    events = spark.readStream.schema("event_id bigint, ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(source)
    counts = stream.hourly_stream_counts(events, "ts")

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    (counts.writeStream.outputMode("complete").foreachBatch(replace)
     .option("checkpointLocation", scratch_path(spark, "counts-state")).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out)


@query("SELECT event_id, event_type, ts FROM events")
def stream_drop_repeats(spark, sf):
    """Every change arrives twice, the second time with the slice after it; the stream lands each once."""
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "landed")
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    edges = [None, "2024-01-08", "2024-01-16", "2024-01-24", None]
    between = lambda i: reduce(lambda a, b: a & b, [F.lit(True), *(
        c for c in (F.col("ts") >= F.lit(edges[i]).cast("timestamp_ntz") if edges[i] else None,
                    F.col("ts") < F.lit(edges[i + 1]).cast("timestamp_ntz") if edges[i + 1] else None) if c is not None)])
    for i in range(4):  # a file a slice, in order
        slice_ = events.where(between(i))
        again = slice_ if i == 0 else events.where(between(i - 1))
        slice_.unionAll(slice_ if i == 3 else slice_.limit(0)).unionAll(again).coalesce(1).write.mode("append").parquet(inbox)
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    once = stream.drop_repeats(rows, ["event_id"], "ts")
    (once.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "repeats-state"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(events.schema).parquet(out)


@query(with_inputs("""SELECT coalesce(a.slot, b.slot) AS slot, coalesce(a.n, 0) AS total_row_source, coalesce(b.n, 0) AS total_row_silver
FROM (SELECT date_trunc('hour', ts) AS slot, count(*) AS n FROM events GROUP BY 1) a
FULL JOIN (SELECT date_trunc('hour', ts) AS slot, count(*) AS n FROM silver_events WHERE event_type <> 'purchase' OR ts < TIMESTAMP '2024-01-12' GROUP BY 1) b ON a.slot = b.slot
WHERE coalesce(a.slot, b.slot) + INTERVAL 1 HOUR <= least((SELECT max(ts) FROM events),
  (SELECT max(ts) FROM silver_events WHERE event_type <> 'purchase' OR ts < TIMESTAMP '2024-01-12')) - INTERVAL 150 MINUTE""", "silver_events"))
def stream_hourly_reconcile(spark, sf):
    """Hourly counts of two streams joined once an hour is closed on both."""
    out, sides = scratch_path(spark, "reconciled"), []
    for label, rows in (("source", table(spark, sf, "events").select("ts")),
                        ("silver", silver_events(spark, sf).where("event_type <> 'purchase' or ts < timestamp_ntz '2024-01-12 00:00:00'").select("ts"))):
        inbox = scratch_path(spark, label)
        for low, high in (("2000-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2100-01-01")):  # a file a slice, in order
            (rows.where((F.col("ts") >= F.lit(low).cast("timestamp_ntz")) & (F.col("ts") < F.lit(high).cast("timestamp_ntz")))
             .coalesce(1).write.mode("append").parquet(inbox))
        sides.append(spark.readStream.schema("ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(inbox))
    joined = stream.hourly_stream_reconcile(*sides, "ts", "ts")
    (joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "reconcile-state"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(joined.schema).parquet(out)


#: Runs in one file of the stream of run-log lines, about 100 MB of lines in memory.
RUNS_PER_FILE = 100_000


@query(ORACLES["runlog_report"])
def stream_run_report(spark, sf):
    """The run report from a stream of log files, read in several batches and each file once."""
    inbox, out = scratch_path(spark, "run-lines"), scratch_path(spark, "runs")
    # more runs make more files, not larger ones; a batch has a quarter of the files, or one for each core
    files = max(4, -(-table(spark, sf, "events").count() // RUNS_PER_FILE))
    at_once = min(-(-files // 4), max(1, spark.sparkContext.defaultParallelism))
    lines = run_log_lines(spark, sf, files)
    lines.write.parquet(inbox)
    rows = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", at_once).parquet(inbox)
    stream.land_runs(rows, out, scratch_path(spark, "runs-state"), every=None).awaitTermination()
    return run_report(stream.landed_runs(spark, out), days=("2024-01-03", "2024-01-28"))


# --- jobs --------------------------------------------------------------------------------------

@query(merge_sql())
def job_full_run(spark, sf):
    """Extract, align, stage as text, merge, drop the staging table."""
    prod = silver_table(spark, silver_orders(spark, sf), "orders")
    spec = JobSpec("orders", "public", "orders", "SELECT * FROM public.orders", scratch_path(spark, "stg"), _unique("stg_orders"),
                   prod, "o_orderkey", "updated_at", op_literal="cron-2-hours")
    full_run(spark, spec, lambda s: stg_orders(spark, sf), as_of=AS_OF)
    return plain(spark.table(prod))


def _by_month(orders: DataFrame) -> DataFrame:
    """Orders with the month of their creation, which a key keeps for good."""
    return orders.withColumn("created_month", F.substring(F.col("created_at").cast("string"), 1, 7))


@query(f"SELECT *, strftime(created_at, '%Y-%m') AS created_month FROM ({merge_sql()}) m")
def job_full_run_partitioned(spark, sf):
    """The same run into a table partitioned by month of creation."""
    prod = silver_table(spark, _by_month(silver_orders(spark, sf)), "orders", ("created_month",))
    spec = JobSpec("orders", "public", "orders", "SELECT * FROM public.orders", scratch_path(spark, "stg"), _unique("stg_orders"),
                   prod, "o_orderkey", "updated_at", op_literal="cron-2-hours")
    full_run(spark, spec, lambda s: _by_month(stg_orders(spark, sf)), as_of=AS_OF)
    return plain(spark.table(prod))


@query(f"SELECT *, strftime(created_at, '%Y-%m') AS created_month FROM ({BACKFILL_RANGE_SQL}) m")
def job_backfill_partitioned(spark, sf):
    dest = silver_table(spark, _by_month(silver_orders(spark, sf)), "orders", ("created_month",))
    source = silver_table(spark, _by_month(backfill_source(spark, sf)), "bronze")
    backfill(spark, BackfillSpec(source, dest, "o_orderkey", op_literal="cron-2-hours", filter_start=BACKFILL_LOW, filter_end=BACKFILL_HIGH),
             as_of=AS_OF)
    return plain(spark.table(dest))


@query(f"SELECT *, strftime(created_at, '%Y-%m') AS created_month FROM ({BACKFILL_RANGE_SQL}) m")
def job_backfill_sliced(spark, sf):
    """The range in four slices of equal row counts, stopped after two and started again."""
    dest = silver_table(spark, _by_month(silver_orders(spark, sf)), "orders", ("created_month",))
    source, ledger = silver_table(spark, _by_month(backfill_source(spark, sf)), "bronze"), scratch_path(spark, "ledger")
    spec = BackfillSpec(source, dest, "o_orderkey", op_literal="cron-2-hours", filter_start=BACKFILL_LOW, filter_end=BACKFILL_HIGH,
                        options={"null_keys": "error"})
    left = [backfill_in_slices(spark, spec, ledger, slices=4, most_slices=2, as_of=AS_OF), backfill_in_slices(spark, spec, ledger)]
    if left != [2, 0]:
        raise AssertionError(left)
    return plain(spark.table(dest))


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, upper(event_type) AS event_type FROM events")
def staging_new_path(spark, sf):
    """A staging table loaded again at another path shows the new load."""
    name, events = _unique("stg_events"), table(spark, sf, "events").select("event_id", "event_type")
    write_staging(events, scratch_path(spark, "staging"), table=name)
    write_staging(events.withColumn("event_type", F.upper("event_type")), scratch_path(spark, "staging"), table=name)
    return spark.table(name)


@query(merge_sql())
def job_rows_from_text(spark, sf):
    """A job row as a settings file gives it, all text; align_ddl=false keeps the extract's column names."""
    prod = silver_table(spark, silver_orders(spark, sf), "orders")
    row = {"job_name": "orders", "pg_schema": "public", "pg_table": "orders", "pg_sql": "SELECT 1", "s3_staging_path": scratch_path(spark, "stg"),
           "staging_table": _unique("stg_orders"), "prod_table": prod, "pk_col": "o_orderkey", "updated_at_col": "updated_at",
           "align_ddl": "false", "debug": "false", "dedupe_source": "true", "dedupe_tiebreakers": "updated_at", "comment": "ignored"}
    spec = JobSpec.from_row(row)
    if spec.align_ddl or spec.debug or not spec.dedupe_source:
        raise AssertionError(spec)
    full_run(spark, spec, lambda s: stg_orders(spark, sf), as_of=AS_OF)
    return plain(spark.table(prod))


@query(BACKFILL_RANGE_SQL)
def job_backfill(spark, sf):
    dest, source = silver_table(spark, silver_orders(spark, sf), "orders"), silver_table(spark, backfill_source(spark, sf), "bronze")
    backfill(spark, BackfillSpec(source, dest, "o_orderkey", op_literal="cron-2-hours", filter_start=BACKFILL_LOW, filter_end=BACKFILL_HIGH),
             as_of=AS_OF)
    return plain(spark.table(dest))


@query(RECONCILE_SQL.replace("'silver' AS catalog_name", "'CATALOG' AS catalog_name").replace("|silver|events|", "|CATALOG|events|")
       .replace("'CATALOG' AS catalog_name,", "").replace("md5(concat('shop|CATALOG|events|', strftime(slot, '%Y-%m-%d'))) AS id,", ""))
def job_reconcile(spark, sf):
    """Check a silver table against its source twice and keep one result per hour (names drawn per run are left out)."""
    silver = silver_table(spark, silver_events(spark, sf), "events")
    database = silver.split(".")[0]
    results = f"{database}.data_quality_check"
    silver_sinks.create_dq_result_table(spark, results, scratch_path(spark, "dq"))
    spec = CheckSpec("events", "public", "events", database, "events", "ts", "ts")
    for as_of in (datetime(2024, 1, 31), AS_OF):
        outcome = reconcile(spark, [spec], lambda schema, name: table(spark, sf, name), LOW, HIGH, results,
                            database_source=DB_SOURCE, as_of=as_of, fail_on_empty=True)
        if outcome.failed_ids:
            raise AssertionError(outcome.failed_ids)
    return plain(spark.table(results).drop("id", "catalog_name"))
