"""Keyed upsert: the new content of a target table after merging a source into it.

Two plans give the same rows.

``full_outer``
    One full outer join on the typed keys. Target and source are shuffled once each; a source
    de-duplicated on the same keys keeps its partitioning, so it is not shuffled again. Rows that
    would pile up in one task go around the join: target rows with a null key, which cannot match,
    and in a source that is not de-duplicated the null and the repeated keys, which either match
    nothing or fail the merge.

``lookup``
    ``target LEFT JOIN source`` for the updates plus ``source ANTI JOIN`` the matched target keys
    for the inserts. There is no hint: Catalyst broadcasts the source only when its size is
    within the session's threshold (the target is then not shuffled at all), and otherwise joins
    by shuffle with adaptive skew splitting, which a full outer join does not get.

``auto`` takes ``lookup`` for a source within the broadcast threshold under a target beyond it: then the
target need not be shuffled. It also takes ``lookup``, for a source of any size, where repeated keys have to be kept or cannot be judged
by key alone (``on_duplicate="allow"``, ``extra_on`` without de-duplication). Else ``full_outer``.
``lookup`` reads its source three times; a caller that runs the merge at once passes ``run_once`` to have it made once.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casting import cast_to_schema
from ..schemas import META_COLUMNS, META_OP
from ..session import fits_broadcast
from .columns import clean_keys, column_types, require_columns, run_metadata, split_by_destination
from .latest import dedupe_source
from .predicates import newer_than

STRATEGIES = ("auto", "full_outer", "lookup")
_CLASH = "two merge source rows match one target row; use dedupe=True"
_HAS_T, _HAS_S, _DELETE = "__in_target", "__in_source", "__is_delete"

Assignments = Mapping[str, "Column | str"]


@dataclass(frozen=True)
class MergeRules:
    """What a merge does, apart from its two inputs.

    ``guard`` names the update-time column that must be strictly newer in the source (None: no
    guard). ``op`` is the run literal stamped into ``__op`` together with the ``__ts_ms`` clock;
    ``op=None`` carries the source's own metadata. ``extra_on``, ``set_`` and ``insert_`` are SQL
    text or columns over the aliases ``t`` and ``s``. ``null_keys`` is ``insert`` (such rows never
    match), ``drop`` or ``error``; ``on_duplicate`` (``error`` / ``allow``) applies when the
    source is not de-duplicated. ``apply_deletes`` removes matched rows whose source ``__op`` is
    ``delete_op``; by default deletes are ordinary rows.
    """

    keys: Sequence[str]
    guard: str | None = None
    op: str | None = "backfill"
    as_of: datetime | None = None
    exclude_update: Sequence[str] = ()
    extra_on: Sequence[Column | str] = ()
    set_: Assignments = field(default_factory=dict)
    insert_: Assignments = field(default_factory=dict)
    dedupe: bool = True
    updated_col: str | None = None
    created_col: str | None = "created_at"
    tiebreakers: Sequence[str] = ()
    numeric_mode: str = "exact"
    locale: str = "auto"
    null_keys: str = "insert"
    on_duplicate: str = "error"
    apply_deletes: bool = False
    delete_op: str = "d"
    strategy: str = "auto"

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", tuple(clean_keys(self.keys)))
        if not self.keys:
            raise ValueError("a merge needs at least one key column")
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        if self.null_keys not in ("insert", "drop", "error"):
            raise ValueError(f"unknown null_keys policy {self.null_keys!r}")
        if self.on_duplicate not in ("error", "allow"):
            raise ValueError(f"unknown on_duplicate policy {self.on_duplicate!r}")


def _ref(side: str, name: str) -> Column:
    return F.col(f"{side}.`{name}`")


def _expr(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(f"`{n}`").isNull() for n in names))


def _fail_when(df: DataFrame, condition: Column, message: str, *, keep: bool = True) -> DataFrame:
    """Raise at run time on any row that meets the condition; other rows stay if ``keep``.

    The test sits in a filter, which column pruning keeps, and counts as non-deterministic, so
    that the optimizer does not move it below a join to rows the join would have removed.
    """
    boom = F.raise_error(F.lit(message)).cast("boolean")
    return df.filter(F.when(condition & (F.spark_partition_id() >= 0), boom).otherwise(F.lit(keep)))


def prepare_source(source: DataFrame, types: Mapping[str, T.DataType], rules: MergeRules) -> DataFrame:
    """Source with destination names and types only, latest row per key, null-key policy applied.

    Casting comes first, so that order and keys are compared as values, not as text.
    """
    kept, ignored = split_by_destination(source.columns, types)
    if ignored:
        warnings.warn(f"columns not in the destination are ignored: {ignored}", stacklevel=3)
    require_columns(source, rules.keys, "merge source")
    if rules.guard and rules.guard.lower() in types:
        require_columns(source, [rules.guard], "merge source (guard column)")
    if rules.op is not None:
        kept = [c for c in kept if c.lower() not in META_COLUMNS]
    times = {x.lower() for x in (rules.created_col, rules.updated_col) if x}
    order_only = [] if not rules.dedupe else [
        c for c in source.columns if c not in kept and c.lower() in times | {x.lower() for x in rules.tiebreakers}
    ]
    picked = source.select(
        *(f"`{c}`" for c in kept + order_only),
        *([F.col(META_OP).eqNullSafe(rules.delete_op).alias(_DELETE)] if rules.apply_deletes else []),
    )
    unstored_times = [c for c in order_only if c.lower() in times and c.lower() not in types]
    schema = T.StructType([T.StructField(name, kind) for name, kind in types.items()]
                          + [T.StructField(c, T.TimestampNTZType()) for c in unstored_times])
    typed = cast_to_schema(picked, schema, numeric_mode=rules.numeric_mode, locale=rules.locale)
    if rules.null_keys == "drop":
        typed = typed.filter(~_any_null(rules.keys))
    elif rules.null_keys == "error":
        typed = _fail_when(typed, _any_null(rules.keys), "merge source has a null key")
    if rules.dedupe:
        typed = dedupe_source(
            typed, rules.keys, updated_col=rules.updated_col or rules.guard,
            created_col=rules.created_col, tiebreakers=rules.tiebreakers,
        )
    return typed.drop(*order_only)


def merge_upsert(target: DataFrame, source: DataFrame, rules: MergeRules, *,
                 run_once: Callable[[DataFrame], DataFrame] = lambda prepared: prepared) -> DataFrame:
    """Target rows after the merge, with the target's columns, order and types.

    Only plans: no job runs. ``run_once`` is applied to the prepared source where the plan reads it more than
    once, for instance :func:`tidemark.session.stable`, which runs it and keeps its rows in the shared folder.
    """
    types = column_types(target)
    require_columns(target, rules.keys, "merge target")
    prepared = prepare_source(source, types, rules)
    return _Merge(target, prepared, rules, types).result(run_once)


class _Merge:
    """Expressions shared by both plans."""

    def __init__(self, target: DataFrame, source: DataFrame, rules: MergeRules, types: Mapping[str, T.DataType],
                 target_name: str = "t"):
        self.rules, self.types, self.target_name = rules, types, target_name
        self.target, self.source = target.alias(self.target_name), source.alias("s")
        self.columns = target.columns
        self.source_names = {name.lower(): name for name in source.columns}
        self.stamp = run_metadata(dict(types), rules.op, rules.as_of) if rules.op is not None else {}
        self.sets = self._known(rules.set_, "SET")
        self.inserts = self._known(rules.insert_, "INSERT")
        keys = [self.t(k) == _ref("s", k) for k in rules.keys]
        self.condition = _all(keys + [_expr(p) for p in rules.extra_on])

    def t(self, name: str) -> Column:
        return _ref(self.target_name, name)

    def _known(self, assignments: Assignments, label: str) -> dict[str, Column]:
        known = {}
        for name, value in assignments.items():
            if name.lower() in self.types:
                known[name.lower()] = _expr(value).cast(self.types[name.lower()])
            else:
                warnings.warn(f"{label} of {name!r} is ignored: not in the destination", stacklevel=5)
        return known

    def _from_source(self, name: str) -> Column | None:
        low = name.lower()
        if low in self.stamp:
            return self.stamp[low]
        return _ref("s", self.source_names[low]) if low in self.source_names else None

    def updated(self, name: str) -> Column:
        low = name.lower()
        if low in self.sets:
            return self.sets[low]
        fixed = {k.lower() for k in (*self.rules.keys, *self.rules.exclude_update)}
        value = None if low in fixed else self._from_source(name)
        return self.t(name) if value is None else value

    def inserted(self, name: str) -> Column:
        low = name.lower()
        value = self.inserts.get(low)
        if value is None:
            value = self._from_source(name)
        return F.lit(None).cast(self.types[low]) if value is None else value

    def applies(self) -> Column:
        guard = self.rules.guard
        if not guard or guard.lower() not in self.types:
            return F.lit(True)
        return newer_than(_ref("s", guard), self.t(guard))

    def deletes(self) -> Column:
        guard = self.rules.guard
        doomed = _ref("s", _DELETE)
        if guard and guard.lower() in self.types:
            doomed = doomed & (_ref("s", guard).isNull() | self.applies())
        return F.coalesce(doomed, F.lit(False))

    def result(self, run_once: Callable[[DataFrame], DataFrame]) -> DataFrame:
        strategy = self.rules.strategy
        if strategy == "auto":
            small = fits_broadcast(self.source) and not fits_broadcast(self.target)
            strategy = "lookup" if small or not (self.rules.dedupe or self._repeats_split()) else "full_outer"
        return self._lookup(run_once(self.source).alias("s")) if strategy == "lookup" else self._full_outer()

    def _repeats_split(self) -> bool:
        """True when repeated source keys can be set apart by key alone."""
        return not self.rules.dedupe and self.rules.on_duplicate == "error" and not self.rules.extra_on

    def _key_match(self, left: str, right: str) -> Column:
        return _all([_ref(left, k) == _ref(right, k) for k in self.rules.keys])

    def _single_keys(self) -> tuple[DataFrame, list[DataFrame]]:
        """Source rows whose key is not repeated, and the branches for the other rows.

        Only keys are counted, with a partial aggregate before the shuffle. The set of repeated
        keys is empty in a sound backfill; adaptive execution then drops the branches built on it.
        """
        keys = self.rules.keys
        null_key = reduce(lambda a, b: a | b, (_ref("s", k).isNull() for k in keys))
        keyed, unkeyed = self.source.filter(~null_key), self.source.filter(null_key)
        repeated = (
            keyed.groupBy(*(_ref("s", k).alias(k) for k in keys)).agg(F.count(F.lit(1)).alias("__rows"))
            .filter(F.col("__rows") > 1).alias("r")
        )
        single = keyed.join(repeated, self._key_match("s", "r"), "left_anti")
        others = keyed.join(repeated, self._key_match("s", "r"), "left_semi")
        clash = repeated.join(self.target, self._key_match("r", self.target_name), "left_semi")
        alarm = _fail_when(clash, F.col("__rows") > 1, _CLASH, keep=False)
        return single.alias("s"), [
            self._live_inserts(unkeyed), self._live_inserts(others.alias("s")), self._no_rows(alarm)]

    def _no_rows(self, checked: DataFrame) -> DataFrame:
        return checked.select(*(F.lit(None).cast(self.types[c.lower()]).alias(c) for c in self.columns))

    def _live_inserts(self, new: DataFrame) -> DataFrame:
        if self.rules.apply_deletes:
            new = new.filter(~_ref("s", _DELETE))
        return new.select(*(self.inserted(c).alias(c) for c in self.columns))

    def _full_outer(self) -> DataFrame:
        nullable = [f.name for f in self.target.schema.fields
                    if f.nullable and f.name.lower() in {k.lower() for k in self.rules.keys}]
        target, aside = self.target, None
        if nullable:
            null_key = reduce(lambda a, b: a | b, (self.t(k).isNull() for k in nullable))
            aside = target.filter(null_key).select(*(self.t(c).alias(c) for c in self.columns))
            target = target.filter(~null_key)
        source, branches = self._single_keys() if self._repeats_split() else (self.source, [])
        t = target.withColumn(_HAS_T, F.lit(True)).alias(self.target_name)
        s = source.withColumn(_HAS_S, F.lit(True)).alias("s")
        has_t, has_s = self.t(_HAS_T).isNotNull(), _ref("s", _HAS_S).isNotNull()
        joined = t.join(s, self.condition, "full_outer")
        if self.rules.apply_deletes:
            gone = has_s & F.when(has_t, self.deletes()).otherwise(_ref("s", _DELETE))
            joined = joined.filter(~gone)
        update = has_s & self.applies()
        merged = joined.select(*(
            F.when(~has_t, self.inserted(c))
            .when(update, self.updated(c))
            .otherwise(self.t(c)).alias(c)
            for c in self.columns
        ))
        return reduce(DataFrame.unionAll, [*([] if aside is None else [aside]), *branches], merged)

    def _lookup(self, source: DataFrame) -> DataFrame:
        rules, branches = self.rules, []
        if rules.dedupe:
            matched_keys = self.target.join(source, self.condition, "left_semi").alias(self.target_name)
            new = source.join(matched_keys, self.condition, "left_anti")
            updates = source
        else:
            # rows that match nothing never reach the update join, however skewed they are
            new = source.join(self.target, self.condition, "left_anti")
            updates = source.join(self.target, self.condition, "left_semi").alias("s")
            if rules.on_duplicate == "error":
                branches.append(self._duplicate_alarm(updates))
        flagged = updates.withColumn(_HAS_S, F.lit(True)).alias("s")
        joined = self.target.join(flagged, self.condition, "left_outer")
        has_s = _ref("s", _HAS_S).isNotNull()
        if rules.apply_deletes:
            joined = joined.filter(~(has_s & self.deletes()))
        update = has_s & self.applies()
        kept = joined.select(*(
            F.when(update, self.updated(c)).otherwise(self.t(c)).alias(c) for c in self.columns
        ))
        return reduce(DataFrame.unionAll, branches, kept.unionAll(self._live_inserts(new)))

    def _duplicate_alarm(self, updates: DataFrame) -> DataFrame:
        """An always empty branch that fails the query when a target row has two source rows."""
        counted = updates.groupBy(*(_ref("s", k).alias(k) for k in self.rules.keys)).agg(
            F.count(F.lit(1)).alias("__rows"))
        return self._no_rows(_fail_when(counted, F.col("__rows") > 1, _CLASH, keep=False))


def merge_into_catalog(spark: SparkSession, table: str, source: DataFrame, rules: MergeRules) -> None:
    """The same merge as ``MERGE INTO``, for catalogs with row-level operations.

    Such a merge has no alias for its target: texts in ``rules`` name it by the table's last name part.
    """
    target = spark.table(table)
    types = column_types(target)
    plan = _Merge(target, prepare_source(source, types, rules), rules, types, table.split(".")[-1].strip("`"))
    keys = {k.lower() for k in rules.keys}
    updates = {c: plan.updated(c) for c in plan.columns if c.lower() not in keys}
    merge = plan.source.mergeInto(table, plan.condition)
    if rules.apply_deletes:
        merge = merge.whenMatched(plan.deletes()).delete()
    if updates:
        merge = merge.whenMatched(plan.applies()).update(updates)
    fresh = merge.whenNotMatched(~_ref("s", _DELETE)) if rules.apply_deletes else merge.whenNotMatched()
    fresh.insert({c: plan.inserted(c) for c in plan.columns}).merge()
