"""Registered queries over the shared test tables, with their DuckDB twins."""

from __future__ import annotations

from .registry import ORACLES, QUERIES, Query


def _load() -> None:
    from . import checking, choices, merging, moving  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
