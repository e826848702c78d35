"""Column naming, alignment to a destination, and run metadata. Schema-level work only."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casting import cast_column
from ..functions.clock import wib_clock
from ..schemas import META_COLUMNS, META_OP, META_TS


def normalize_name(name: str | None, position: int = 0) -> str:
    """Lower case, ``[a-z0-9_]`` only, single underscores; metadata names stay as they are."""
    text = (name or "").strip().lower()
    if not text:
        return f"col_{position}"
    if text in META_COLUMNS:
        return text
    text = re.sub(r"[^a-z0-9]+", "_", text).strip("_")
    if not text:
        return "col"
    return f"_{text}" if text[0].isdigit() else text


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new.lower() in seen:
            raise ValueError(f"columns {seen[new.lower()]!r} and {old!r} both become {new!r}")
        seen[new.lower()] = old
    return df.toDF(*names)


def normalize_names(df: DataFrame) -> DataFrame:
    return _renamed(df, [normalize_name(name, i) for i, name in enumerate(df.columns)])


def align_columns(
    df: DataFrame,
    ddl_columns: Sequence[str] = (),
    destination_columns: Sequence[str] = (),
    *,
    by: str = "auto",
) -> DataFrame:
    """Rename columns to the destination's, keep extras, normalise every name.

    ``by="auto"``: by name when any name matches, else by position.
    ``by="name"``: by name only. ``by="position"``: the last *n* columns take the *n* target
    names, or the first ones when there are fewer columns than names.
    ``by="compat"``: by position when the count equals the source DDL's, else by name when all
    names match, else by position.
    """
    if by not in ("auto", "name", "position", "compat"):
        raise ValueError(f"unknown alignment {by!r}")
    own = list(df.columns)
    target = [c for c in (destination_columns or ddl_columns) if c.lower() not in META_COLUMNS]
    if not target:
        return normalize_names(df)

    by_lower = {name.lower(): name for name in target}
    matched = [name for name in own if name.lower() in by_lower]
    if by == "compat" and ddl_columns and len(own) == len(ddl_columns):
        names = list(ddl_columns)
    elif by == "name" or (by == "auto" and matched) or (by == "compat" and len({m.lower() for m in matched}) == len(by_lower)):
        names = [by_lower.get(name.lower(), name) for name in own]
    else:
        names = _positional(own, target)
    return _renamed(df, [normalize_name(name, i) for i, name in enumerate(names)])


def _positional(own: list[str], target: list[str]) -> list[str]:
    spare = len(own) - len(target)
    if spare >= 0:
        return own[:spare] + target
    warnings.warn(f"{len(own)} columns for {len(target)} names: aligning the first {len(own)}", stacklevel=3)
    return target[: len(own)]


def computed_key(df: DataFrame, name: str, parts: Sequence[str], separator: str = "") -> DataFrame:
    """A key column joined from other columns; a null part counts as empty text."""
    texts = [F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")) for part in parts]
    return df.withColumn(name, F.concat_ws(separator, *texts))


def require_columns(df: DataFrame, needed: Iterable[str], context: str = "input") -> None:
    have = {name.lower() for name in df.columns}
    missing = [name for name in needed if name.lower() not in have]
    if missing:
        raise ValueError(f"{context} lacks column(s) {missing}; it has {df.columns}")


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    """Lower-case name to type."""
    return {field.name.lower(): field.dataType for field in df.schema.fields}


def split_by_destination(columns: Sequence[str], destination: Iterable[str]) -> tuple[list[str], list[str]]:
    """Columns the destination has, and the ones it will ignore."""
    have = {name.lower() for name in destination}
    return ([c for c in columns if c.lower() in have], [c for c in columns if c.lower() not in have])


def keep_destination_columns(df: DataFrame, destination: Iterable[str]) -> DataFrame:
    kept, ignored = split_by_destination(df.columns, destination)
    if ignored:
        warnings.warn(f"columns not in the destination are ignored: {ignored}", stacklevel=2)
    return df.select(*(f"`{name}`" for name in kept))


def clean_keys(keys: str | Iterable[str]) -> list[str]:
    """Trim, drop blanks, drop repeats, keep order; a comma list is accepted."""
    parts = keys.split(",") if isinstance(keys, str) else list(keys)
    return list(dict.fromkeys(part.strip() for part in parts if part and part.strip()))


def resolve_tiebreakers(tiebreakers: str | Iterable[str], keys: str | Iterable[str], updated_col: str | None) -> list[str]:
    """``id`` stands for the key columns and ``updated_at`` for the job's update column."""
    names: list[str] = []
    for name in clean_keys(tiebreakers):
        if name == "id":
            names.extend(clean_keys(keys))
        elif name == "updated_at" and updated_col:
            names.extend(clean_keys(updated_col))
        else:
            names.append(name)
    return clean_keys(names)


def run_metadata(types: dict[str, T.DataType], op: str, as_of: datetime | None = None) -> dict[str, Column]:
    """``__op`` (the run's literal) and ``__ts_ms`` (Jakarta wall clock) where the destination has them."""
    made: dict[str, Column] = {}
    if META_OP in types:
        made[META_OP] = cast_column(F.lit(op), types[META_OP], source=T.StringType())
    if META_TS in types:
        made[META_TS] = wib_clock(as_of).cast(types[META_TS])
    return made


def add_run_metadata(df: DataFrame, op: str, as_of: datetime | None = None,
                     types: dict[str, T.DataType] | None = None) -> DataFrame:
    kinds = types or {META_OP: T.StringType(), META_TS: T.TimestampNTZType()}
    return df.withColumns(run_metadata(kinds, op, as_of))
