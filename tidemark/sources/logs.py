"""Run-status documents and quality-run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import DQ_RUN_LOG, DQ_RUN_LOG_PARTITIONS, RUN_STATUS


def read_run_status(spark: SparkSession, *paths: str, multi_line: bool = True) -> DataFrame:
    """Run-status JSON; ``multi_line`` for one document per file, off for one per line."""
    reader = spark.read.schema(RUN_STATUS).option("multiLine", multi_line).option("recursiveFileLookup", True)
    return reader.json(list(paths))


def read_dq_run_log(spark: SparkSession, base: str) -> DataFrame:
    """Quality-run CSV logs with their ``dt, hour, source`` folders as text columns.

    New folders are found on every read; nothing has to be registered.
    """
    partitions = [T.StructField(name, T.StringType()) for name in DQ_RUN_LOG_PARTITIONS]
    schema = T.StructType([*DQ_RUN_LOG.fields, *partitions])
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", "\\").csv(base)
