"""Fixed row shapes of the tables and documents the jobs exchange."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()
_TS = T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


#: Metadata columns a silver or landing table may carry.
META_OP, META_TS = "__op", "__ts_ms"
META_COLUMNS = (META_OP, META_TS)

#: Hourly quality check results.
DQ_RESULT = _struct(
    ("id", _S), ("database_source", _S), ("catalog_name", _S), ("table_name", _S),
    ("created_at", T.DateType()), ("created_hours", _S),
    ("total_row_silver", _L), ("total_row_source", _L),
    ("status", _S), ("diff", _L), ("large", _S), ("ingestion_at", _TS),
)
DQ_RESULT_KEYS = ("id", "created_at", "created_hours")

#: One line per quality run, CSV.
DQ_RUN_LOG = _struct(
    ("DATABASE_SOURCE", _S), ("TABLE_NAME", _S), ("RUN_START_ISO", _S),
    ("RUN_END_ISO", _S), ("JOB_STATUS", _S), ("TOTAL_DURATIONS", _I),
)
DQ_RUN_LOG_PARTITIONS = ("dt", "hour", "source")

#: One JSON document per job run.
RUN_STATUS = _struct(
    ("run_id", _S), ("job", _S), ("exit_code", _I), ("status", _S), ("host", _S),
    ("pg_schema", _S), ("pg_table", _S), ("staging_table", _S), ("prod_table", _S),
    ("started_at_utc", _S), ("ended_at_utc", _S), ("started_at_wib", _S),
    ("ended_at_wib", _S), ("timezone_wib", _S), ("duration_seconds", _I), ("log_s3_uri", _S),
)

#: Per-job deadline and runtime target.
JOB_SLA = _struct(("job", _S), ("cutoff_wib", _S), ("slo_seconds", _I))

#: Scorecard grades.
KPI_THRESHOLD = _struct(
    ("kpi", _S), ("weight", T.DoubleType()), ("green", T.DoubleType()),
    ("amber", T.DoubleType()), ("higher_is_better", T.BooleanType()),
)


def with_columns(*groups: T.StructType) -> T.StructType:
    """Concatenate structs, e.g. user columns + metadata."""
    return T.StructType([field for group in groups for field in group.fields])


META_STRUCT = _struct((META_OP, _S), (META_TS, _TS))

# Type names as the catalogs report them.
_NAMED_TYPES = {
    "tinyint": T.ByteType(), "smallint": T.ShortType(), "integer": T.IntegerType(),
    "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "double precision": T.DoubleType(), "real": T.FloatType(), "float": T.FloatType(),
    "boolean": T.BooleanType(), "bool": T.BooleanType(), "date": T.DateType(),
    "string": T.StringType(), "varchar": T.StringType(), "char": T.StringType(),
    "text": T.StringType(),
}


def type_from_name(name: str) -> T.DataType:
    """Catalog type name to Spark type; every timestamp flavour is the zone-less timestamp."""
    text = " ".join((name or "").lower().split())
    if text.startswith("timestamp"):
        return _TS
    if text in _NAMED_TYPES:
        return _NAMED_TYPES[text]
    sized = re.fullmatch(r"(decimal|numeric|varchar|char)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", text)
    if sized:
        kind, size, scale = sized.group(1), int(sized.group(2)), int(sized.group(3) or 0)
        if kind in ("decimal", "numeric"):
            return T.DecimalType(size, scale)
        return T.VarcharType(size) if kind == "varchar" else T.CharType(size)
    if text in ("decimal", "numeric"):
        return T.DecimalType(38, 0)
    return T.DataType.fromDDL(text)


def schema_from_names(columns: dict[str, str]) -> T.StructType:
    """``{"id": "bigint", "price": "decimal(12,2)"}`` to a StructType."""
    return _struct(*((name, type_from_name(kind)) for name, kind in columns.items()))
