"""Operators for training-data pipelines, and their registered queries.

Functions of this subpackage that run in Spark's Python workers are pickled by value, so executors need the
libraries they use but no copy of this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def queries() -> dict:
    from .queries import QUERIES

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from .queries import ORACLES

    return dict(ORACLES)
