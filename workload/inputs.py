"""Job inputs derived from whole driver tables, as frames and as DuckDB SQL.

Frames and SQL of the same name hold the same rows. Splits between "already loaded" and "new"
use business columns (dates, values); every input row takes part.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import ntz, trunc

LOADED_BEFORE = datetime(2000, 1, 1)
AS_OF = datetime(2024, 2, 1, 3, 30, 15, 250000)
AS_OF_WIB_SQL = "TIMESTAMP '2024-02-01 10:30:15.250'"
LOST_ABOVE, DOUBLED_BELOW = 150.0, 2.0
WINDOW = (datetime(2024, 1, 1), datetime(2024, 1, 31))
DB_SOURCE = "shop"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def padded(col: Column) -> Column:
    return F.lpad(col.cast("string"), 2, "0")


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Group rows for a partitioned write over all cores; small data would end in one writer otherwise."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *columns)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as text, the common ground of both engines' clients."""
    kinds = {T.DecimalType: "double", T.DateType: "string"}
    return df.select(*(
        F.col(f"`{f.name}`").cast(kinds[type(f.dataType)]).alias(f.name) if type(f.dataType) in kinds
        else F.col(f"`{f.name}`") for f in df.schema.fields))


# --- orders: silver target and staged changes --------------------------------------------------

def silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.filter(F.col("o_orderdate") < ntz(LOADED_BEFORE)).select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
        F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"),
        F.lit("initial").alias("__op"), F.lit(None).cast("timestamp_ntz").alias("__ts_ms"))


def typed_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Every order once or twice; the second version is a day newer and has status X."""
    o = table(spark, sf, "orders").withColumn("v", F.explode(F.sequence(F.lit(0), (F.col("o_orderkey") % 2).cast("int"))))
    days = (F.col("o_orderkey") % 7 - 3 + F.col("v")).cast("int")
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("v") == 1, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"), F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderdate") + F.make_dt_interval(days)).alias("updated_at"))


def stg_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The changes as staged text: six number styles, one of them blank."""
    c = typed_changes(spark, sf)
    price = F.col("o_totalprice").cast("string")
    english = F.format_number(F.col("o_totalprice"), 2)
    style = F.col("o_orderkey") % 6
    text = (
        F.when(style == 0, price).when(style == 1, F.concat(F.lit("Rp "), price))
        .when(style == 2, F.replace(price, F.lit("."), F.lit(","))).when(style == 3, F.lit(""))
        .when(style == 4, english).otherwise(F.translate(english, ",.", ".,")))
    return c.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus", text.alias("o_totalprice"), F.col("created_at").cast("string").alias("created_at"),
        F.col("updated_at").cast("string").alias("updated_at"))


SQL = {
    "silver_orders": """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
  o_orderdate AS created_at, o_orderdate AS updated_at, 'initial' AS __op, CAST(NULL AS TIMESTAMP) AS __ts_ms
FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'""",
    "typed_changes": """SELECT o_orderkey, o_custkey, CASE WHEN v = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate AS created_at,
  o_orderdate + to_days(CAST(o_orderkey % 7 - 3 + v AS INTEGER)) AS updated_at
FROM (SELECT *, unnest(range(0, o_orderkey % 2 + 1)) AS v FROM orders) x""",
    "latest_changes": """SELECT * FROM typed_changes
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY coalesce(updated_at, created_at) DESC, o_orderkey DESC) = 1""",
    # the meaning of the staged text: style 3 of 6 is blank
    "staged_values": """SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 6 = 3 THEN NULL ELSE o_totalprice END AS o_totalprice, created_at, updated_at
FROM latest_changes""",
}


# --- events: quality check pair, change log, run log --------------------------------------------

def silver_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as they arrived: large values were lost, tiny ones came twice."""
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.filter(F.col("value") <= LOST_ABOVE).unionAll(e.filter(F.col("value") < DOUBLED_BELOW))


SQL["silver_events"] = """SELECT event_id, ts, user_id, event_type, value FROM events WHERE value <= 150.0
UNION ALL SELECT event_id, ts, user_id, event_type, value FROM events WHERE value < 2.0"""


def cdc_changes(spark: SparkSession, sf: str) -> DataFrame:
    digit = F.col("event_id") % 10
    return table(spark, sf, "events").select(
        F.col("user_id").alias("id"), "event_type", F.col("value").cast("decimal(12,2)").cast("string").alias("amount"),
        F.when(digit == 0, F.lit("d")).when(digit < 4, F.lit("c")).otherwise(F.lit("u")).alias("__op"),
        F.col("ts").alias("__ts_ms"), "event_id")


SQL["cdc_changes"] = """SELECT user_id AS id, event_type, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS amount,
  CASE WHEN event_id % 10 = 0 THEN 'd' WHEN event_id % 10 < 4 THEN 'c' ELSE 'u' END AS __op, ts AS __ts_ms, event_id
FROM events"""


def runs(spark: SparkSession, sf: str) -> DataFrame:
    start, seconds = trunc("second", F.col("ts")), F.floor("value").cast("int")
    failed = F.col("event_id") % 11 == 0
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"), F.col("event_type").alias("job"), start.alias("started_at"),
        (start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).alias("ended_at"),
        seconds.alias("duration_seconds"), F.when(failed, 1).otherwise(0).alias("exit_code"),
        F.when(failed, F.lit("ERROR")).when(F.col("event_id") % 13 == 0, F.lit("ok")).otherwise(F.lit("SUCCESS")).alias("status"),
        trunc("minute", F.col("ts")).alias("scheduled_at"))


SQL["runs"] = """SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS job, date_trunc('second', ts) AS started_at,
  date_trunc('second', ts) + to_seconds(CAST(floor(value) AS INTEGER)) AS ended_at,
  CAST(floor(value) AS INTEGER) AS duration_seconds, CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS exit_code,
  CASE WHEN event_id % 11 = 0 THEN 'ERROR' WHEN event_id % 13 = 0 THEN 'ok' ELSE 'SUCCESS' END AS status,
  date_trunc('minute', ts) AS scheduled_at FROM events"""


def job_sla(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_type").alias("job")).distinct().select(
        "job", F.lit("18:00:00").alias("cutoff_wib"),
        F.when(F.col("job") == "purchase", 100).otherwise(150).alias("slo_seconds"))


SQL["job_sla"] = """SELECT DISTINCT event_type AS job, '18:00:00' AS cutoff_wib,
  CASE WHEN event_type = 'purchase' THEN 100 ELSE 150 END AS slo_seconds FROM events"""


def order_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders read as runs, for trends over several quarters."""
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("job"), F.col("o_orderdate").alias("started_at"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("duration_seconds"))


SQL["order_runs"] = """SELECT o_orderpriority AS job, o_orderdate AS started_at,
  CAST(floor(o_totalprice / 1000) AS INTEGER) AS duration_seconds FROM orders"""


def run_log_lines(spark: SparkSession, sf: str, parts: int | None = None) -> DataFrame:
    """Five text lines per run; the table name is missing from every seventh run's file.

    With ``parts`` the runs are dealt out to so many partitions, all lines of a run's file together.
    """
    bad, key, n = F.col("event_id") % 11 == 0, F.col("event_id").cast("string"), F.col("n")
    kind = F.col("event_type")
    system = F.concat(F.lit("db"), (F.col("event_id") % 3).cast("string"))
    file = [kind.alias("job"), F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"),
            F.concat(F.lit("s3://bucket/logs/cron-batch/"), system, F.lit("/"), kind, F.lit("/"), key,
                     F.lit("/monitoring/status.json")).alias("src")]
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    if parts:  # before the lines are made, which are many times as large
        e = e.repartition(parts, *file)
    e = e.select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("n"))
    line = (
        F.when(n == 0, F.concat(F.lit('"run_id": "'), key, F.lit('",')))
        .when(n == 1, F.concat(F.lit('"exit_code": '), F.when(bad, F.lit("1")).otherwise(F.lit("0")), F.lit(",")))
        .when(n == 2, F.concat(F.lit('"status": "'), F.when(bad, F.lit("ERROR")).otherwise(F.lit("SUCCESS")), F.lit('",')))
        .when(n == 3, F.when(F.col("event_id") % 7 == 0, F.lit("}")).otherwise(
            F.concat(F.lit('"pg_table": "t_'), kind, F.lit('",'))))
        .otherwise(F.concat(F.lit('"prod_table": "p_'), kind, F.lit('",'))))
    return e.select(system.alias("system"), *file, line.alias("line"))


SQL["run_log_lines"] = """SELECT concat('db', CAST(event_id % 3 AS VARCHAR)) AS system, event_type AS job,
  CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  concat('s3://bucket/logs/cron-batch/db', CAST(event_id % 3 AS VARCHAR), '/', event_type, '/', CAST(event_id AS VARCHAR), '/monitoring/status.json') AS src,
  CASE n WHEN 0 THEN concat('"run_id": "', CAST(event_id AS VARCHAR), '",')
         WHEN 1 THEN concat('"exit_code": ', CASE WHEN event_id % 11 = 0 THEN '1' ELSE '0' END, ',')
         WHEN 2 THEN concat('"status": "', CASE WHEN event_id % 11 = 0 THEN 'ERROR' ELSE 'SUCCESS' END, '",')
         WHEN 3 THEN CASE WHEN event_id % 7 = 0 THEN '}' ELSE concat('"pg_table": "t_', event_type, '",') END
         ELSE concat('"prod_table": "p_', event_type, '",') END AS line
FROM (SELECT *, unnest(range(0, 5)) AS n FROM events) x"""


def dq_run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as quality runs of three sources, scheduled three times a day."""
    start, seconds = trunc("second", F.col("ts")), F.floor("value").cast("int")
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    return table(spark, sf, "events").select(
        F.concat(F.lit("db_"), (F.col("user_id") % 3).cast("string")).alias("DATABASE_SOURCE"),
        F.col("event_type").alias("TABLE_NAME"),
        F.concat(F.date_format(start, iso), F.lit("+07:00")).alias("RUN_START_ISO"),
        F.concat(F.date_format(start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)")), iso), F.lit("+07:00")).alias("RUN_END_ISO"),
        F.when(F.col("event_id") % 17 == 0, F.lit("ERR")).otherwise(F.lit("OK")).alias("JOB_STATUS"),
        seconds.alias("TOTAL_DURATIONS"), F.date_format("ts", "yyyy-MM-dd").alias("dt"), padded(F.floor(F.hour("ts") / 8) * 8).alias("hour"),
        F.concat(F.lit("db_"), (F.col("user_id") % 3).cast("string")).alias("source"))


SQL["dq_run_log"] = """SELECT concat('db_', CAST(user_id % 3 AS VARCHAR)) AS "DATABASE_SOURCE", event_type AS "TABLE_NAME",
  concat(strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S'), '+07:00') AS "RUN_START_ISO",
  concat(strftime(date_trunc('second', ts) + to_seconds(CAST(floor(value) AS INTEGER)), '%Y-%m-%dT%H:%M:%S'), '+07:00') AS "RUN_END_ISO",
  CASE WHEN event_id % 17 = 0 THEN 'ERR' ELSE 'OK' END AS "JOB_STATUS", CAST(floor(value) AS INTEGER) AS "TOTAL_DURATIONS",
  strftime(ts, '%Y-%m-%d') AS dt, lpad(CAST(hour(ts) // 8 * 8 AS VARCHAR), 2, '0') AS hour, concat('db_', CAST(user_id % 3 AS VARCHAR)) AS source
FROM events"""


# --- text of every number, truth and time style ------------------------------------------------

def number_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Line prices and quantities as text in twelve styles."""
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    english = F.format_number(F.col("l_extendedprice").cast("decimal(12,2)"), 2)
    quantity = F.col("l_quantity").cast("int").cast("string")
    style = (F.col("l_orderkey") + F.col("l_linenumber")) % 12
    styles = [
        price, F.concat(F.lit("Rp "), price), F.replace(price, F.lit("."), F.lit(",")), F.translate(english, ",.", ".,"),
        english, F.lit("  "), F.concat(F.lit("\u00a0"), price, F.lit(" ")), F.concat(F.lit("-"), price),
        F.concat(quantity, F.lit("e2")), F.concat(F.lit("."), quantity), F.concat(quantity, F.lit("-3")),
        F.concat(F.lit("n/a "), F.col("l_returnflag")),
    ]
    text = F.lit(None).cast("string")
    for number, value in reversed(list(enumerate(styles))):
        text = F.when(style == number, value).otherwise(text)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.alias("t"))


_PRICE = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"
_ENGLISH = "format('{:,.2f}', l_extendedprice)"
_QTY = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
# with the style and the numbers behind the text, from which the expected values follow
SQL["number_texts"] = f"""SELECT l_orderkey, l_linenumber, l_partkey, (l_orderkey + l_linenumber) % 12 AS style,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS INTEGER) AS quantity, CASE (l_orderkey + l_linenumber) % 12
  WHEN 0 THEN {_PRICE} WHEN 1 THEN concat('Rp ', {_PRICE}) WHEN 2 THEN replace({_PRICE}, '.', ',')
  WHEN 3 THEN translate({_ENGLISH}, ',.', '.,') WHEN 4 THEN {_ENGLISH} WHEN 5 THEN '  '
  WHEN 6 THEN concat(chr(160), {_PRICE}, ' ') WHEN 7 THEN concat('-', {_PRICE}) WHEN 8 THEN concat({_QTY}, 'e2')
  WHEN 9 THEN concat('.', {_QTY}) WHEN 10 THEN concat({_QTY}, '-3') ELSE concat('n/a ', l_returnflag) END AS t
FROM lineitem"""


def with_inputs(query: str, *names: str) -> str:
    """Prefix a DuckDB query with the inputs it needs."""
    return "WITH " + ",\n".join(f"{name} AS (\n{SQL[name]}\n)" for name in names) + "\n" + query
