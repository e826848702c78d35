"""Change streams: flatten, land by hour, upsert in micro-batches, count by hour."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.casting import decimal_text, micros_time, millis_time
from ..functions.clock import trunc
from ..operators.reconcile import SILVER_ROWS, SOURCE_ROWS
from ..operators.runlog import extract_runs
from ..operators.upsert import MergeRules
from ..schemas import META_OP, META_TS
from ..session import estimated_bytes
from ..sinks.silver import merge_table, partition_columns, supports_row_merge
from ..sources.partitioned import HOUR_COLUMNS

LAND_EVERY, UPSERT_EVERY = "5 minutes", "15 minutes"
#: Largest unpartitioned table that a stream may rewrite with every batch.
REWRITE_LIMIT = 64 << 30


def drop_tombstones(records: DataFrame, value: str = "value") -> DataFrame:
    """Null-value records follow a delete and carry no image."""
    return records.filter(F.col(value).isNotNull())


def flatten_changes(records: DataFrame, *, envelope: str = "value", image: str = "after", before: str = "before",
                    record_key: str | None = None, keys: Sequence[str] = (), op: str = "op", ts_ms: str = "ts_ms") -> DataFrame:
    """Envelope struct to its after-image columns plus ``__op`` and ``__ts_ms``.

    A delete has no after-image: its columns come from the before-image, where the envelope has one,
    and the ``keys`` that are still null from the struct column ``record_key``. With ``keys`` given, a
    record without any key value is dropped: it names no row.
    """
    kind = records.schema[envelope].dataType
    fields, images = kind[image].dataType.names, [image]
    if before in kind.names:
        images.append(before)
    columns = {n: [F.col(f"{envelope}.{i}.`{n}`") for i in images if n in kind[i].dataType.names] for n in fields}
    if record_key is not None:
        for n in keys:
            columns[n].append(F.col(f"{record_key}.`{n}`"))
    # an update that sets a column to null keeps it: later images count only without an after-image
    there = F.col(f"{envelope}.{image}").isNotNull()
    values = {n: F.when(there, found[0]).otherwise(F.coalesce(*found[1:])) if len(found) > 1 else found[0] for n, found in columns.items()}
    values |= {n: F.coalesce(*columns[n]) for n in keys}
    flat = drop_tombstones(records, envelope).select(
        *(values[n].alias(n) for n in fields),
        F.col(f"{envelope}.{op}").alias(META_OP),
        millis_time(F.col(f"{envelope}.{ts_ms}")).alias(META_TS),
    )
    return flat.dropna("all", subset=list(keys)) if keys else flat


def decode_changes(changes: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Decimals sent as text and times sent as microseconds, to their column types."""
    decoded = {}
    for name, kind in types.items():
        if isinstance(kind, T.DecimalType):
            decoded[name] = decimal_text(F.col(f"`{name}`"), kind.precision, kind.scale)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            decoded[name] = micros_time(F.col(f"`{name}`")).cast(kind)
    return changes.withColumns(decoded)


def with_hour_folders(df: DataFrame, ts: str = META_TS) -> DataFrame:
    """``yyyy, mm, dd, hh`` of the change time, as text with leading zeros, as hour scans expect them."""
    moment = F.col(f"`{ts}`")
    return df.withColumns({name: F.date_format(moment, part) for name, part in zip(HOUR_COLUMNS, ("yyyy", "MM", "dd", "HH"))})


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def land_by_hour(changes: DataFrame, path: str, checkpoint: str, *, ts: str = META_TS,
                 every: str | None = LAND_EVERY) -> StreamingQuery:
    """Append a stream to Parquet in hour folders; ``every=None`` takes what is there and stops."""
    writer = (
        with_hour_folders(changes, ts).writeStream.format("parquet").outputMode("append")
        .partitionBy(*HOUR_COLUMNS).option("checkpointLocation", checkpoint).option("path", path)
    )
    return _trigger(writer, every).start()


def upsert_stream(
    changes: DataFrame,
    table: str,
    rules: MergeRules,
    checkpoint: str,
    *,
    partitions: Sequence[str] = (),
    every: str | None = UPSERT_EVERY,
    rewrite_limit: int = REWRITE_LIMIT,
) -> StreamingQuery:
    """Merge every micro-batch into a silver table.

    A batch that is delivered again is harmless. An unpartitioned table keeps the last batch of every
    stream with each version, whoever wrote it, and a batch already published is skipped; a stream is
    known by the id that Spark keeps in its checkpoint, so a new checkpoint is a new stream. A
    partitioned table has no such mark: there the guard and the de-duplication make a second merge
    change nothing, except for rows with null keys, which are therefore refused unless ``null_keys``
    drops them or fails. Late and repeated records need no watermark, because the state is the
    table. Other sessions see a new version after ``REFRESH TABLE``.

    Every batch rewrites an unpartitioned table. Beyond ``rewrite_limit`` bytes (Catalyst's
    estimate) that is refused: partition the table, or raise the limit knowingly.
    """
    owner, known = changes.sparkSession, {}
    parts = partition_columns(owner, table)
    if parts and rules.null_keys == "insert":
        raise ValueError("a stream into a partitioned table needs null_keys='drop' or 'error'")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if parts or supports_row_merge(spark, table):
            merge_table(spark, table, batch, rules, partitions)
        else:
            if not known:
                known["id"] = stream_id(spark, checkpoint)
            size = estimated_bytes(spark.table(table))
            if size is not None and size > rewrite_limit:
                raise ValueError(f"{table} has about {size} bytes and each batch would rewrite it: partition it or raise rewrite_limit")
            merge_table(spark, table, batch, rules, partitions, batch=(known["id"], batch_id))
        # batches run in a session of their own; the starting session must see the new files too
        owner.catalog.refreshTable(table)

    return _trigger(
        changes.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint), every).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when it first used this checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def hourly_stream_counts(events: DataFrame, ts: str, *, lateness: str = "2 hours 30 minutes") -> DataFrame:
    """Rows per hour of a stream under a watermark; state is one row per open hour."""
    return (
        events.withColumn("__t", F.col(f"`{ts}`").cast("timestamp")).withWatermark("__t", lateness)
        .groupBy(F.window("__t", "1 hour")).agg(F.count(F.lit(1)).alias("total_rows"))
        .select(trunc("hour", F.col("window.start")).alias("slot"), "total_rows")
    )


def drop_repeats(changes: DataFrame, keys: Sequence[str], ts: str = META_TS, *, lateness: str = "2 hours 30 minutes") -> DataFrame:
    """Change rows without those that a restarted connector sent again.

    The first row of each key stays; a row with the same ``keys`` is dropped while it comes within ``lateness`` of the first. The state
    holds the keys of that span only. Keys name one change (for instance key and log position), not one table row. Rows later than
    ``lateness`` are dropped: their repeats can no longer be told.
    """
    moment = changes.withColumn("__t", F.col(f"`{ts}`").cast("timestamp")).withWatermark("__t", lateness)
    return moment.dropDuplicatesWithinWatermark(list(keys)).drop("__t")


def hourly_stream_reconcile(source: DataFrame, silver: DataFrame, source_ts: str, silver_ts: str, *,
                            lateness: str = "2 hours 30 minutes") -> DataFrame:
    """Both sides' rows per hour once the hour is closed: ``slot, total_row_source, total_row_silver``.

    Two windowed counts under watermarks meet in a full outer join of streams, in append mode: an hour comes out when the slower
    stream's watermark has passed it, with 0 for a side without rows. State is one row per open hour and side.
    """
    def side(rows: DataFrame, ts: str, name: str) -> DataFrame:
        moment = rows.select(F.col(f"`{ts}`").cast("timestamp").alias("__t")).withWatermark("__t", lateness)
        return moment.groupBy(F.window("__t", "1 hour").alias("hour")).agg(F.count(F.lit(1)).alias(name))

    both = side(source, source_ts, SOURCE_ROWS).join(side(silver, silver_ts, SILVER_ROWS), "hour", "full_outer")
    return both.select(trunc("hour", F.col("hour.start").cast("timestamp_ntz")).alias("slot"),
                       *(F.coalesce(n, F.lit(0)).alias(n) for n in (SOURCE_ROWS, SILVER_ROWS)))


def land_runs(lines: DataFrame, path: str, checkpoint: str, *, every: str | None = LAND_EVERY) -> StreamingQuery:
    """Runs of new log files, from a stream of their lines; files read once are not read again.

    ``lines`` has ``job, year, month, day, src, line``; all lines of a file come in one batch, as file streams give them. Each batch has
    a folder of its own, so a batch that is delivered again replaces itself. Read them with :func:`landed_runs`.
    """
    def keep(batch: DataFrame, batch_id: int) -> None:
        extract_runs(batch, path_like=None).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return _trigger(lines.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint), every).start()


def landed_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run rows of all batches that :func:`land_runs` has written."""
    return spark.read.parquet(f"{path.rstrip('/')}/batch=*")
