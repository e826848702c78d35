"""Keep lake tables in step with their source databases, and show that they are.

Everything is a ``DataFrame -> DataFrame`` function or a job composed of them:

* :mod:`tidemark.functions`: text-to-type casts, clocks, small rules
* :mod:`tidemark.operators`: column alignment, filters, latest row per key, upsert, reconcile, run logs, KPIs
* :mod:`tidemark.sources`, :mod:`tidemark.sinks`: scans, staging, silver tables, logs
* :mod:`tidemark.streaming`: change streams
* :mod:`tidemark.plans`: stage, merge, backfill and reconcile jobs
"""

from .functions.casting import cast_column, cast_to_schema
from .operators.columns import align_columns
from .operators.latest import current_state, dedupe_source, latest_per_key
from .operators.reconcile import CheckSpec, reconcile_check, reconcile_many
from .operators.upsert import MergeRules, merge_upsert
from .plans.jobs import BackfillSpec, JobSpec, backfill, full_run, merge, reconcile, run_jobs, stage
from .plans.slices import backfill_in_slices
from .session import configure

__all__ = [
    "BackfillSpec", "CheckSpec", "JobSpec", "MergeRules", "align_columns", "backfill", "backfill_in_slices", "cast_column", "cast_to_schema",
    "configure", "current_state", "dedupe_source", "full_run", "latest_per_key", "merge", "merge_upsert", "reconcile",
    "reconcile_check", "reconcile_many", "run_jobs", "stage",
]
