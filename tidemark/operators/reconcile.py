"""Hourly row-count reconciliation of a source with its silver copy.

Rows of both sides are counted by one partial + final hash aggregate, so only hour counts cross
the network; grid and counts are a few rows per hour whatever the data size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import hour_text, ntz, trunc, wib_clock
from ..functions.rules import check_id, count_gap, gap_status, larger_side
from ..schemas import DQ_RESULT, DQ_RESULT_KEYS
from ..session import stable
from .columns import require_columns
from .predicates import check_filter, time_of
from .upsert import MergeRules, merge_upsert

SLOT, SOURCE_ROWS, SILVER_ROWS = "slot", "total_row_source", "total_row_silver"


@dataclass(frozen=True)
class CheckSpec:
    """One source/silver pair to compare. The fields are those of the check list's rows."""

    id: str
    src_schema: str
    src_table: str
    slv_db: str
    slv_table: str
    src_ts: str
    slv_ts: str
    src_pred: str = ""
    slv_pred: str = ""

    def __post_init__(self) -> None:
        for name, value in vars(self).items():
            object.__setattr__(self, name, (value or "").strip())
        blank = [n for n, v in vars(self).items() if not v and n not in ("src_pred", "slv_pred")]
        if blank:
            raise ValueError(f"check needs {blank}")


@dataclass(frozen=True)
class CheckOutcome:
    """Results of the good checks, and the ids and errors of the others."""

    results: DataFrame
    failures: DataFrame
    failed_ids: tuple[str, ...]


def hour_grid(spark: SparkSession, low: datetime, high: datetime) -> DataFrame:
    """One row per hour of ``[low, high)``."""
    hours = F.sequence(trunc("hour", ntz(low)), ntz(high - timedelta(microseconds=1)), F.expr("interval 1 hour"))
    return spark.range(1).select(F.explode(hours).alias(SLOT))


def covered_hours(df: DataFrame, ts: str) -> DataFrame:
    """One row per hour from the first to the last event of ``df``."""
    moment = time_of(df, ts)
    span = df.agg(F.min(moment).alias("lo"), F.max(moment).alias("hi")).filter("lo is not null")
    hours = F.sequence(trunc("hour", F.col("lo")), trunc("hour", F.col("hi")), F.expr("interval 1 hour"))
    return span.select(F.explode(hours).alias(SLOT))


def hourly_counts(df: DataFrame, ts: str, low: datetime, high: datetime, *, predicate: str = "",
                  name: str = SOURCE_ROWS) -> DataFrame:
    """Rows per hour of ``[low, high)``."""
    return (
        check_filter(df, ts, low, high, predicate)
        .groupBy(trunc("hour", time_of(df, ts)).alias(SLOT))
        .agg(F.count(F.lit(1)).alias(name))
    )


def fill_hours(grid: DataFrame, counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every grid hour, missing counts as zero."""
    require_columns(counts, [SLOT, *names], "hour counts")
    return grid.join(counts.select(SLOT, *names), SLOT, "left").fillna(0, list(names))


def compare_counts(source_counts: DataFrame, silver_counts: DataFrame) -> DataFrame:
    """Hours of either side with both counts, missing ones as zero."""
    joined = source_counts.join(silver_counts, SLOT, "full_outer")
    return joined.fillna(0, [SOURCE_ROWS, SILVER_ROWS]).select(SLOT, SOURCE_ROWS, SILVER_ROWS)


def count_both(spec: CheckSpec, source: DataFrame, silver: DataFrame, low: datetime, high: datetime) -> DataFrame:
    """Both sides counted in one aggregate: the same rows as :func:`compare_counts`, one shuffle."""
    def tagged(df: DataFrame, ts: str, predicate: str, is_source: int) -> DataFrame:
        return check_filter(df, ts, low, high, predicate).select(
            trunc("hour", time_of(df, ts)).alias(SLOT),
            F.lit(is_source).cast("long").alias(SOURCE_ROWS),
            F.lit(1 - is_source).cast("long").alias(SILVER_ROWS),
        )

    both = tagged(source, spec.src_ts, spec.src_pred, 1).unionAll(tagged(silver, spec.slv_ts, spec.slv_pred, 0))
    return both.groupBy(SLOT).agg(F.sum(SOURCE_ROWS).alias(SOURCE_ROWS), F.sum(SILVER_ROWS).alias(SILVER_ROWS))


def count_group(specs: Sequence[CheckSpec], source: DataFrame, silver: DataFrame, low: datetime, high: datetime) -> DataFrame:
    """Counts of many checks of one table pair and time columns: one scan a side, one conditional count a check and side.

    Columns: the hour, then ``__s0, __v0, __s1, ...`` in the order of ``specs``.
    """
    def side(df: DataFrame, ts: str, own: list[str], mark: str, other: str) -> DataFrame:
        rows = check_filter(df, ts, low, high)
        hit = [F.coalesce(F.expr(f"({p})"), F.lit(False)) if p.strip() else F.lit(True) for p in own]
        return rows.select(trunc("hour", time_of(df, ts)).alias(SLOT), *(h.alias(f"{mark}{i}") for i, h in enumerate(hit)),
                           *(F.lit(False).alias(f"{other}{i}") for i in range(len(own))))

    first = specs[0]
    both = side(source, first.src_ts, [c.src_pred for c in specs], "__s", "__v").unionByName(
        side(silver, first.slv_ts, [c.slv_pred for c in specs], "__v", "__s"))
    return both.groupBy(SLOT).agg(*(F.count_if(f"{m}{i}").alias(f"{m}{i}") for i in range(len(specs)) for m in ("__s", "__v")))


def reconcile_group(specs: Sequence[CheckSpec], source: DataFrame, silver: DataFrame, low: datetime, high: datetime, **options) -> DataFrame:
    """Result rows of checks that share their tables and time columns."""
    include = options.pop("include_predicates", False)
    counts = count_group(specs, source, silver, low, high)
    names = [f"{m}{i}" for i in range(len(specs)) for m in ("__s", "__v")]
    filled = fill_hours(hour_grid(source.sparkSession, low, high), counts, names)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("check"), F.col(f"__s{i}").alias(SOURCE_ROWS), F.col(f"__v{i}").alias(SILVER_ROWS))
                                for i in range(len(specs))]))
    rows = filled.select(SLOT, pairs.alias("__p")).select(SLOT, "__p.*")
    predicates = [F.element_at(F.array(*[F.lit(p) for p in own]), F.col("check") + 1)
                  for own in ([c.src_pred for c in specs], [c.slv_pred for c in specs])] if include else []
    return _result_rows(rows, specs[0], predicates, **options)


def reconcile_check(
    spec: CheckSpec,
    source: DataFrame,
    silver: DataFrame,
    low: datetime,
    high: datetime,
    *,
    database_source: str,
    as_of: datetime | None = None,
    include_predicates: bool = False,
) -> DataFrame:
    """Result rows of one check, one per hour.

    The result id leaves out the predicates, so two checks of one table and day share it;
    ``include_predicates`` keeps them apart.
    """
    grid = hour_grid(source.sparkSession, low, high)
    counts = fill_hours(grid, count_both(spec, source, silver, low, high), [SOURCE_ROWS, SILVER_ROWS])
    extra = [F.lit(spec.src_pred), F.lit(spec.slv_pred)] if include_predicates else []
    return _result_rows(counts, spec, extra, database_source=database_source, as_of=as_of)


def _result_rows(counts: DataFrame, spec: CheckSpec, extra: Sequence[Column], *, database_source: str, as_of: datetime | None = None) -> DataFrame:
    slv, src, day = F.col(SILVER_ROWS), F.col(SOURCE_ROWS), F.col(SLOT).cast("date")
    values = {
        "id": check_id(day, database_source, spec.slv_db, spec.slv_table, *extra),
        "database_source": F.lit(database_source),
        "catalog_name": F.lit(spec.slv_db),
        "table_name": F.lit(spec.slv_table),
        "created_at": day,
        "created_hours": hour_text(F.col(SLOT)),
        SILVER_ROWS: slv,
        SOURCE_ROWS: src,
        "status": gap_status(slv, src),
        "diff": count_gap(slv, src),
        "large": larger_side(slv, src),
        "ingestion_at": wib_clock(as_of),
    }
    return counts.select(*(values[f.name].cast(f.dataType).alias(f.name) for f in DQ_RESULT.fields))


def reconcile_many(
    spark: SparkSession,
    specs: Sequence[CheckSpec],
    read_source: Callable[[str, str], DataFrame],
    read_silver: Callable[[str, str], DataFrame],
    low: datetime,
    high: datetime,
    **options,
) -> CheckOutcome:
    """All checks as one plan; a check whose tables or columns do not resolve is set aside.

    Checks of the same tables and time columns are counted together, so their number adds no scans.
    """
    groups: dict[tuple, list[CheckSpec]] = {}
    failures: list[tuple[str, str]] = []
    for spec in specs:
        try:
            # planned alone, so that one that does not resolve costs no other
            reconcile_check(spec, read_source(spec.src_schema, spec.src_table), read_silver(spec.slv_db, spec.slv_table), low, high, **options)
            groups.setdefault((spec.src_schema, spec.src_table, spec.slv_db, spec.slv_table, spec.src_ts, spec.slv_ts), []).append(spec)
        except (PySparkException, ValueError, KeyError) as problem:
            failures.append((spec.id, str(problem)))
    frames = [reconcile_group(own, read_source(*key[:2]), read_silver(*key[2:4]), low, high, **options) for key, own in groups.items()]
    results = reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], DQ_RESULT)
    failed = spark.createDataFrame(failures, "check_id string, error string")
    return CheckOutcome(results, failed, tuple(check for check, _ in failures))


def run_checks(spark: SparkSession, specs: Sequence[CheckSpec], *where, **options) -> CheckOutcome:
    """:func:`reconcile_many`, run: a few rows per hour from large scans, kept in the shared folder.

    When the common plan fails while it runs, the checks run one by one and only the broken ones are set aside.
    """
    whole = reconcile_many(spark, specs, *where, **options)
    try:
        return replace(whole, results=stable(whole.results))
    except PySparkException:
        pass
    done, failures = [], [tuple(r) for r in whole.failures.collect()]
    for spec in (s for s in specs if s.id not in whole.failed_ids):
        try:
            done.append(stable(reconcile_many(spark, [spec], *where, **options).results))
        except PySparkException as problem:
            failures.append((spec.id, str(problem)))
    results = reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], DQ_RESULT)
    return CheckOutcome(results, spark.createDataFrame(failures, "check_id string, error string"), tuple(c for c, _ in failures))


def require_rows(df: DataFrame, fail_on_empty: bool) -> DataFrame:
    if fail_on_empty and df.isEmpty():
        raise ValueError("no check result to write")
    return df


def upsert_results(stored: DataFrame, results: DataFrame, *, strategy: str = "auto") -> DataFrame:
    """Replace stored rows of the same id, day and hour; a rerun of a day overwrites it.

    The results are checkpointed first: a few rows per hour that cost two scans to make.
    """
    return merge_upsert(stored, stable(results), MergeRules(
        keys=DQ_RESULT_KEYS, guard=None, op=None, dedupe=False, strategy=strategy))

