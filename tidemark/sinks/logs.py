"""Run-status and quality-run log records."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from ..functions.clock import WIB, naive_utc
from ..schemas import DQ_RUN_LOG, DQ_RUN_LOG_PARTITIONS, RUN_STATUS

_WIB_SHIFT = timedelta(hours=7)


def run_status_row(
    *, run_id: str, job: str, exit_code: int, started_at: datetime, ended_at: datetime, host: str = "",
    pg_schema: str = "", pg_table: str = "", staging_table: str = "", prod_table: str = "", log_uri: str = "",
) -> dict:
    """One run-status record; times in UTC and Jakarta text."""
    start, end = naive_utc(started_at).replace(microsecond=0), naive_utc(ended_at).replace(microsecond=0)
    utc, wib = "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S+0700"
    return {
        "run_id": run_id, "job": job, "exit_code": exit_code, "status": "SUCCESS" if exit_code == 0 else "ERROR",
        "host": host, "pg_schema": pg_schema, "pg_table": pg_table, "staging_table": staging_table,
        "prod_table": prod_table, "started_at_utc": start.strftime(utc), "ended_at_utc": end.strftime(utc),
        "started_at_wib": (start + _WIB_SHIFT).strftime(wib), "ended_at_wib": (end + _WIB_SHIFT).strftime(wib),
        "timezone_wib": WIB, "duration_seconds": int((end - start).total_seconds()), "log_s3_uri": log_uri,
    }


def status_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[f.name] for f in RUN_STATUS.fields) for r in rows], RUN_STATUS)


def write_run_status(spark: SparkSession, base: str, row: dict) -> str:
    """One JSON document, ``job/yyyy/mm/dd/run_id/monitoring/status.json``; the same run's is replaced."""
    day = datetime.strptime(row["started_at_utc"], "%Y-%m-%dT%H:%M:%SZ")
    path = f"{base.rstrip('/')}/{row['job']}/{day:%Y/%m/%d}/{row['run_id']}/monitoring/status.json"
    write_document(spark, path, json.dumps({f.name: row[f.name] for f in RUN_STATUS.fields}, indent=2) + "\n")
    return path


def write_document(spark: SparkSession, path: str, text: str) -> None:
    """A small file of just that name, which a DataFrame writer cannot make, on any file system that Spark writes to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_run_statuses(df: DataFrame, path: str) -> None:
    """Many run-status records, one JSON document per line."""
    df.select(*(f.name for f in RUN_STATUS.fields)).write.mode("append").json(path)


def write_dq_run_log(df: DataFrame, base: str) -> None:
    """Quality-run records as quoted CSV under ``dt=/hour=/source=``."""
    names = [f.name for f in DQ_RUN_LOG.fields]
    (
        df.select(*names, *DQ_RUN_LOG_PARTITIONS)
        .write.mode("append").partitionBy(*DQ_RUN_LOG_PARTITIONS)
        .option("header", True).option("quote", '"').option("escape", "\\").csv(base)
    )
