"""Settings the operators rely on. Sessions themselves come from ``SparkSession.builder``."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    # epoch values are UTC instants without a zone of their own
    "spark.sql.session.timeZone": "UTC",
    # field names are case-sensitive: "Motorista" and "motorista" are two columns
    "spark.sql.caseSensitive": "true",
    # a JSON object that repeats a key keeps the last value
    "spark.sql.variant.allowDuplicateKeys": "true",
    # the folder walk is bounded by the data, not by a cap on rows or levels
    "spark.sql.cteRecursionRowLimit": "-1",
    "spark.sql.cteRecursionLevelLimit": "-1",
    # a task that lists folders takes many of them: starting it costs more than a folder does
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SESSION_CONF` to a running session and return it."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for ``DataFrame.checkpoint`` and for stream checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local master,
    as used in tests, falls back to a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="formtide-checkpoint-")
    context.setCheckpointDir(folder)
    return folder
