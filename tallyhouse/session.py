"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Runtime SQL settings every job relies on. Cluster sizing (executors, shuffle partitions,
#: broadcast threshold) stays with whoever submits the job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot join key is worth one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # session windows of one hot key are merged before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_fallback_root: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder path that every executor can reach.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a session on ``local[...]``, where driver and
    executors are one process, may leave it unset and gets a temporary folder; elsewhere that is an error.
    """
    global _fallback_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = getattr(spark, "sparkContext", None)
        if context is not None and context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _fallback_root is None:
            _fallback_root = tempfile.mkdtemp(prefix="tallyhouse-")
        root = _fallback_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
