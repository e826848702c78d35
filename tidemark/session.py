"""Session helpers: recommended settings, shared scratch folder, plan size estimate."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job here relies on. Shuffle partition counts are left to the cluster:
#: adaptive execution coalesces small ones and splits skewed ones at run time.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # partition values such as hour=07 must stay text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SESSION_CONF` to a running session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only by a ``local`` master with that setting unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="tidemark-")
            spark.sparkContext.setCheckpointDir(_local_scratch[app])
        base = _local_scratch[app]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder, so later stages and retries all see the same rows."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's upper estimate of a plan's size, or None where the session does not expose it."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, times: int = 1) -> bool:
    """True when the estimate is within the session's own broadcast threshold (or a multiple of it)."""
    size = estimated_bytes(df)
    if size is None:
        return False
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size <= limit * times
