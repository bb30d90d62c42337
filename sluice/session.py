"""Session construction and the shared working folder.

On a cluster the shared folder is the one named by ``spark.checkpoint.dir``
(or an already configured SparkContext checkpoint dir). Only when neither is
set -- local runs and tests -- do we make one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job here relies on. AQE re-plans joins and coalesces
# shuffle partitions from runtime sizes; skew-join splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one extra shuffle
    # above the join (the plans here let aggregates reuse the join's
    # partitioning, which otherwise blocks the split).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Broadcast decisions from measured shuffle sizes (AQE), not estimates.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "sluice",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session, then the SparkContext's
    checkpoint dir. Only if both are unset (local mode, tests) a folder is made
    under the system temp dir and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: a cluster job needs a shared folder"
        )
    local = tempfile.mkdtemp(prefix="sluice-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared folder; a fresh one per call when ``unique``."""
    pieces = [shared_root(spark), "sluice", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return "/".join(p.strip("/") if i else p for i, p in enumerate(pieces))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable target."""
    return shared_root(spark)
