"""Latest row per key.

``row_number() = 1`` over a key window: Spark turns it into a group limit that runs before the
shuffle as well as after, so a key with very many versions sends at most one row per input
partition and no task ever buffers a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import META_OP, META_TS
from .columns import clean_keys, require_columns

_RANK = "__latest_rank"


def latest_order(
    df: DataFrame,
    keys: Sequence[str],
    updated_col: str | None = "updated_at",
    created_col: str | None = "created_at",
    tiebreakers: Sequence[str] = (),
) -> list[Column]:
    """Newest first: update time (else creation time), then tie-breakers, then keys."""
    have = {name.lower() for name in df.columns}
    require_columns(df, tiebreakers, "tie-breaker order")
    times = [F.col(f"`{c}`") for c in (updated_col, created_col) if c and c.lower() in have]
    order = [F.coalesce(*times)] if times else []
    order += [F.col(f"`{name}`") for name in (*tiebreakers, *keys)]
    return [col.desc_nulls_last() for col in order]


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order``.

    A hash of the whole row ends the order, so a task that is run again picks the same row.
    """
    key_list = clean_keys(keys)
    require_columns(df, key_list, "latest_per_key")
    tie = F.xxhash64(*(F.col(f"`{name}`") for name in df.columns)).desc()
    window = Window.partitionBy(*(F.col(f"`{k}`") for k in key_list)).orderBy(*order, tie)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedupe_source(
    df: DataFrame,
    keys: str | Sequence[str],
    *,
    updated_col: str | None = "updated_at",
    created_col: str | None = "created_at",
    tiebreakers: Sequence[str] = (),
) -> DataFrame:
    """Latest row per key by the merge job's order."""
    key_list = clean_keys(keys)
    return latest_per_key(df, key_list, latest_order(df, key_list, updated_col, created_col, tiebreakers))


def current_state(
    changes: DataFrame,
    keys: str | Sequence[str],
    *,
    change_time: str = META_TS,
    sequence: Sequence[str] = (),
    drop_deleted: bool = False,
    op_col: str = META_OP,
    delete_op: str = "d",
) -> DataFrame:
    """Last change per key of a change log; optionally without keys whose last change is a delete."""
    order = [F.col(f"`{name}`").desc_nulls_last() for name in (change_time, *sequence)]
    last = latest_per_key(changes, keys, order)
    if drop_deleted:
        last = last.filter(~F.col(f"`{op_col}`").eqNullSafe(delete_op))
    return last
