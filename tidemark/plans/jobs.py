"""Jobs: stage, merge, backfill, reconcile, and the table-driven runner."""

from __future__ import annotations

import socket
import uuid
import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields, replace
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..functions.casting import flag_is_set
from ..functions.clock import naive_utc
from ..operators.columns import align_columns, clean_keys, normalize_name, resolve_tiebreakers
from ..operators.predicates import backfill_filter
from ..operators.reconcile import CheckOutcome, CheckSpec, run_checks, require_rows
from ..operators.upsert import MergeRules
from ..schemas import DQ_RESULT_KEYS
from ..sinks.logs import run_status_row, status_frame, write_run_status
from ..sinks.silver import merge_table
from ..sinks.staging import drop_staging, write_staging
from ..sources.relations import table_columns

# The fields a job row must have; a row without one of them is skipped.
REQUIRED_JOB_FIELDS = (
    "job_name", "pg_schema", "pg_table", "pg_sql", "s3_staging_path", "staging_table", "prod_table",
    "pk_col", "updated_at_col",
)


@dataclass(frozen=True)
class JobSpec:
    """One scheduled merge."""

    job_name: str
    pg_schema: str
    pg_table: str
    pg_sql: str
    s3_staging_path: str
    staging_table: str
    prod_table: str
    pk_col: str
    updated_at_col: str
    align_ddl: bool = True
    align_by: str = "auto"
    debug: bool = False
    dedupe_source: bool = True
    dedupe_tiebreakers: str = "updated_at,id"
    op_literal: str = "cron-2-hours"
    guard: bool = True
    partitions: Sequence[str] = ()
    write_mode: str = "overwrite_partitions"
    exclude_update: Sequence[str] = ()
    extra_on: Sequence[str] = ()
    drop_staging: bool = True
    purge_staging: bool = False
    options: Mapping[str, object] = field(default_factory=dict)

    @classmethod
    def from_row(cls, row: Mapping[str, object]) -> "JobSpec | None":
        """Spec of a job row, or None (with a warning) when a required field is blank."""
        for name in REQUIRED_JOB_FIELDS:
            if not str(row.get(name) or "").strip():
                warnings.warn(f"job row skipped, no {name!r}: {dict(row)}", stacklevel=2)
                return None
        known = {f.name: f for f in fields(cls)}
        values = {k: v for k, v in row.items() if k in known and v not in (None, "")}
        # flags come as text such as true, false, yes or 0
        values |= {k: flag_is_set(v) for k, v in values.items() if known[k].type == "bool" and not isinstance(v, bool)}
        return cls(**values)

    def rules(self, staged_columns: Sequence[str], as_of: datetime | None = None) -> MergeRules:
        keys = [normalize_name(k) for k in clean_keys(self.pk_col)]
        return MergeRules(
            keys=keys, guard=self.updated_at_col if self.guard else None, updated_col=self.updated_at_col,
            op=self.op_literal, as_of=as_of, dedupe=self.dedupe_source, exclude_update=self.exclude_update,
            extra_on=self.extra_on,
            tiebreakers=[c for c in resolve_tiebreakers(self.dedupe_tiebreakers, keys, self.updated_at_col)
                         if c in staged_columns],
            **self.options,
        )


Extract = Callable[[JobSpec], DataFrame]


def stage(spark: SparkSession, spec: JobSpec, extract: Extract, *, ddl_columns: Sequence[str] = (),
          as_of: datetime | None = None) -> list[str]:
    """Extract, align, write the staging table; returns its columns."""
    frame = extract(spec)
    if spec.align_ddl:
        destination = table_columns(spark, spec.prod_table) if spark.catalog.tableExists(spec.prod_table) else ()
        frame = align_columns(frame, ddl_columns, destination, by=spec.align_by)
    write_staging(frame, spec.s3_staging_path, table=spec.staging_table, partitions=spec.partitions,
                  mode=spec.write_mode, as_of=as_of)
    return table_columns(spark, spec.staging_table)


def merge(spark: SparkSession, spec: JobSpec, *, as_of: datetime | None = None) -> None:
    """Merge the staging table into the silver table, then drop it when asked."""
    staged = spark.table(spec.staging_table)
    merge_table(spark, spec.prod_table, staged, spec.rules(staged.columns, as_of))
    if spec.drop_staging:
        problem = drop_staging(spark, spec.staging_table, purge=spec.purge_staging)
        if problem:
            warnings.warn(f"staging table {spec.staging_table} not dropped: {problem}", stacklevel=2)


def full_run(spark: SparkSession, spec: JobSpec, extract: Extract, *, ddl_columns: Sequence[str] = (),
             as_of: datetime | None = None) -> None:
    stage(spark, spec, extract, ddl_columns=ddl_columns, as_of=as_of)
    merge(spark, spec, as_of=as_of)


@dataclass(frozen=True)
class BackfillSpec:
    """One table-to-table merge."""

    source_table: str
    dest_table: str
    keys: str
    updated_at_col: str | None = "updated_at"
    op_literal: str = "backfill"
    filter_col: str | None = None
    filter_start: datetime | str | None = None
    filter_end: datetime | str | None = None
    dedupe: bool = False
    exclude_update: Sequence[str] = ()
    extra_on: Sequence[str] = ()
    options: Mapping[str, object] = field(default_factory=dict)

    def rules(self, as_of: datetime | None = None) -> MergeRules:
        return MergeRules(keys=clean_keys(self.keys), guard=self.updated_at_col, op=self.op_literal, as_of=as_of,
                          dedupe=self.dedupe, exclude_update=self.exclude_update, extra_on=self.extra_on, **self.options)


def backfill(spark: SparkSession, spec: BackfillSpec, *, as_of: datetime | None = None) -> None:
    source = backfill_filter(
        spark.table(spec.source_table), updated_col=spec.updated_at_col, filter_col=spec.filter_col,
        start=spec.filter_start, end=spec.filter_end, as_of=as_of)
    merge_table(spark, spec.dest_table, source, spec.rules(as_of))


def reconcile(
    spark: SparkSession,
    specs: Sequence[CheckSpec],
    read_source: Callable[[str, str], DataFrame],
    low: datetime,
    high: datetime,
    result_table: str,
    *,
    database_source: str,
    as_of: datetime | None = None,
    fail_on_empty: bool = False,
    include_predicates: bool = False,
) -> CheckOutcome:
    """Run the checks, upsert their results; checks that cannot be planned or fail while running are returned, not raised."""
    outcome = run_checks(
        spark, specs, read_source, lambda db, table: spark.table(f"`{db}`.`{table}`"), low, high,
        database_source=database_source, as_of=as_of, include_predicates=include_predicates)
    results = require_rows(outcome.results, fail_on_empty)
    merge_table(spark, result_table, results, MergeRules(keys=DQ_RESULT_KEYS, op=None, dedupe=False))
    return replace(outcome, results=results)


def run_jobs(
    spark: SparkSession,
    rows: Sequence[Mapping[str, object] | JobSpec],
    extract: Extract,
    *,
    status_base: str | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    at_once: int = 1,
) -> DataFrame:
    """Run merge jobs, ``at_once`` of them side by side; a failed job does not stop the rest.

    Jobs of one silver or staging table run in the order given. Each job's Spark jobs go to a scheduler pool of its name, so that under
    ``spark.scheduler.mode=FAIR`` a short job does not wait for a long one's tasks. Returns (and optionally writes) one run-status row
    per job, in the order given.
    """
    specs = [s for s in (row if isinstance(row, JobSpec) else JobSpec.from_row(row) for row in rows) if s is not None]

    def run(spec: JobSpec) -> dict:
        started, code = clock(), 0
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.job_name)
        try:
            full_run(spark, spec, extract, as_of=naive_utc(started))
        except Exception as problem:  # noqa: BLE001 - the outcome is recorded per job
            warnings.warn(f"job {spec.job_name} failed: {problem}", stacklevel=2)
            code = 1
        status = run_status_row(
            run_id=uuid.uuid4().hex[:8], job=spec.job_name, exit_code=code, started_at=started, ended_at=clock(),
            host=socket.gethostname(), pg_schema=spec.pg_schema, pg_table=spec.pg_table,
            staging_table=spec.staging_table, prod_table=spec.prod_table)
        if status_base:
            write_run_status(spark, status_base, status)
        return status

    pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
    try:
        if at_once <= 1:
            done = {i: run(spec) for i, spec in enumerate(specs)}
        else:
            done = _side_by_side(spark, specs, run, at_once)
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
    return status_frame(spark, [done[i] for i in range(len(specs))])


def _side_by_side(spark: SparkSession, specs: Sequence[JobSpec], run: Callable[[JobSpec], dict], at_once: int) -> dict[int, dict]:
    """Chains of jobs that share a table, each chain in one thread, which inherits the session's local properties."""
    chains: list[tuple[set[str], list[int]]] = []
    for i, spec in enumerate(specs):
        tables, members = {spec.prod_table.lower(), spec.staging_table.lower()}, [i]
        for other in [c for c in chains if c[0] & tables]:
            chains.remove(other)
            tables, members = tables | other[0], other[1] + members
        chains.append((tables, sorted(members)))
    with ThreadPoolExecutor(at_once) as threads:
        started = [threads.submit(inheritable_thread_target(spark)(lambda own: {i: run(specs[i]) for i in own}), own) for _, own in chains]
        return {i: status for each in started for i, status in each.result().items()}

