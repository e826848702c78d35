"""Change-stream sources.

Kafka and Avro need their Spark packages on the class path; file streams do not.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_topic(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Stream of ``key, value, topic, partition, offset, timestamp``; one topic per table."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).options(**dict(options or {})).load()
    )


def avro_value(value: Column, schema_json: str, *, registry_header: bool = True) -> Column:
    """Decode Avro bytes; the registry puts a 5-byte header before them."""
    from pyspark.sql.avro.functions import from_avro

    body = F.substring(value, 6, 2147483647) if registry_header else value
    return from_avro(body, schema_json, {"mode": "PERMISSIVE"})


def json_value(value: Column, schema: T.StructType) -> Column:
    return F.from_json(value.cast("string"), schema)


def read_change_files(spark: SparkSession, path: str, schema: T.StructType, *, files_per_batch: int | None = None,
                      file_format: str = "json") -> DataFrame:
    """Stream over files of flattened change records."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
