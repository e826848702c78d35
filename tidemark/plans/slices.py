"""Backfills that may stop and start again: the range is cut into slices, a ledger keeps those that are merged.

The cuts are row-count quantiles of the filter column, so slices hold about equally many rows however unevenly the times lie. Rows
of one time stay together: a time that owns a third of all rows makes one larger slice, which the merge splits over tasks as it does
any source.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from math import ceil

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import naive_utc, ntz
from ..operators.predicates import backfill_filter, time_of
from ..sinks.silver import merge_table, partition_columns, supports_row_merge
from .jobs import BackfillSpec

ROWS_PER_SLICE = 50_000_000

_PLAN = "backfill string, spec string, as_of string, slice int, low string, high string"
_DONE = "backfill string, slice int, merged_at string"


def quantile_cuts(df: DataFrame, name: str, slices: int) -> list[datetime]:
    """Times that cut the rows into ``slices`` parts of about equal row counts; fewer where times repeat.

    Reads one column; what reaches the driver is one time per cut.
    """
    if slices < 2:
        return []
    moment = time_of(df, name).cast("timestamp_ntz")
    shares = F.array(*(F.lit(i / slices) for i in range(1, slices)))
    found = df.agg(F.percentile_approx(moment, shares, max(10_000, 100 * slices)).alias("cuts"), F.min(moment).alias("least")).first()
    return sorted({c for c in found.cuts or () if c > found.least})


def _within(df: DataFrame, name: str, low: str | None, high: str | None) -> DataFrame:
    """Rows of one slice. The first one has no lower bound and takes the rows without a time."""
    moment = time_of(df, name)
    if low is not None:
        df = df.filter(moment >= ntz(low))
    if high is not None:
        below: Column = moment < ntz(high)
        df = df.filter(below if low is not None else below | moment.isNull())
    return df


def _read(spark: SparkSession, path: str, schema: str) -> list[Row]:
    """A ledger's records, one per slice; none where nothing is written yet."""
    try:
        return spark.read.schema(schema).json(path).collect()
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return []


def _write(spark: SparkSession, path: str, schema: str, rows: list[tuple], mode: str) -> None:
    # one file, so a writer that dies leaves all records or none
    spark.createDataFrame(rows, schema).coalesce(1).write.mode(mode).json(path)


def _planned(spark: SparkSession, spec: BackfillSpec, ledger: str, name: str, slices: int | None, rows_per_slice: int,
             as_of: datetime | None) -> list[Row]:
    plan = _read(spark, f"{ledger}/plan", _PLAN)
    if not plan:
        moment = naive_utc(as_of or datetime.now(timezone.utc))
        source = _source(spark, spec, moment)
        if slices is None:
            slices = ceil(source.count() / rows_per_slice)
        cuts: list[str | None] = [str(c) for c in quantile_cuts(source, name, slices)]
        known = uuid.uuid4().hex
        _write(spark, f"{ledger}/plan", _PLAN, [(known, repr(spec), str(moment), i, low, high)
                                               for i, (low, high) in enumerate(zip([None, *cuts], [*cuts, None], strict=True))], "overwrite")
        plan = _read(spark, f"{ledger}/plan", _PLAN)
    if plan[0].spec != repr(spec):
        raise ValueError(f"the ledger {ledger} belongs to another backfill: {plan[0].spec}")
    return sorted(plan, key=lambda r: r.slice)


def _source(spark: SparkSession, spec: BackfillSpec, as_of: datetime) -> DataFrame:
    return backfill_filter(spark.table(spec.source_table), updated_col=spec.updated_at_col, filter_col=spec.filter_col,
                           start=spec.filter_start, end=spec.filter_end, as_of=as_of)


def _mark(spark: SparkSession, ledger: str, backfill: str, number: int) -> None:
    _write(spark, f"{ledger}/done", _DONE, [(backfill, number, str(datetime.now(timezone.utc)))], "append")


def backfill_in_slices(
    spark: SparkSession,
    spec: BackfillSpec,
    ledger: str,
    *,
    slices: int | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    most_slices: int | None = None,
    as_of: datetime | None = None,
) -> int:
    """Merge a range slice by slice in time order; returns how many slices are still open (0: finished).

    The first call writes the slices and ``as_of`` to the folder ``ledger``; later calls with the same spec go on with the slices not
    marked there and read no others, whatever ``slices`` they ask for. ``most_slices`` ends a call early. A slice that was merged but
    not marked, because the driver was lost in between, is offered again: an unpartitioned table knows it by its mark and skips it, in
    other tables a second merge changes nothing but rows with null keys, which are therefore refused unless ``null_keys`` drops them
    or fails. One call at a time may work on a ledger.

    Each slice is de-duplicated and checked for repeated keys by itself: of a key with rows in several slices the latest slice is merged
    last (under a guard the newest row stays), where one merge of the whole range without de-duplication would fail. Rows that enter
    the source behind a finished slice are not seen. Rows without a time are in the first slice, where the range lets them in at all.
    An empty range is one empty slice.
    """
    source = spark.table(spec.source_table)
    name = spec.filter_col or spec.updated_at_col
    if not name or name.lower() not in {c.lower() for c in source.columns}:
        raise ValueError(f"slices need a time column; {name!r} is not in {spec.source_table}")
    marked = not (partition_columns(spark, spec.dest_table) or supports_row_merge(spark, spec.dest_table))
    if not marked and spec.rules().null_keys == "insert":
        raise ValueError("a sliced backfill into a partitioned table needs null_keys='drop' or 'error'")
    plan = _planned(spark, spec, ledger, name, slices, rows_per_slice, as_of)
    moment, known = datetime.fromisoformat(plan[0].as_of), plan[0].backfill
    done = {r.slice for r in _read(spark, f"{ledger}/done", _DONE) if r.backfill == known}
    waiting = [p for p in plan if p.slice not in done]
    now = waiting if most_slices is None else waiting[:most_slices]
    for part in now:
        merge_table(spark, spec.dest_table, _within(_source(spark, spec, moment), name, part.low, part.high), spec.rules(moment),
                    batch=(f"backfill {known}", part.slice) if marked else None)
        _mark(spark, ledger, known, part.slice)
    return len(waiting) - len(now)
