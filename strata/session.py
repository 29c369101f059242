"""Spark session and shared-storage helpers.

Everything that has to survive an executor loss (staged files, snapshots,
checkpoints) lives under the shared folder the cluster names in
``spark.checkpoint.dir``.  We only invent a folder when that setting is
absent, which is the case in unit tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster job wants regardless of size: AQE re-plans joins and
# coalesces/splits shuffle partitions from runtime statistics, skew-join
# splits hot partitions, and session time zone is pinned so date keys do
# not depend on the machine.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_fallback_root: str | None = None


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for staged data: ``spark.checkpoint.dir`` if the
    cluster sets it, else (local masters only) a fresh local folder that is
    also registered as the checkpoint dir."""
    global _fallback_root
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _fallback_root is None:
            _fallback_root = tempfile.mkdtemp(prefix="strata-")
        spark.sparkContext.setCheckpointDir(os.path.join(_fallback_root, "checkpoints"))
        return _fallback_root
    return _fallback_root or os.path.dirname(spark.sparkContext.getCheckpointDir())


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder name under the shared root (never reused)."""
    return f"{shared_root(spark)}/strata/{purpose}-{uuid.uuid4().hex[:12]}"
