"""Session defaults.

Everything here is plain Spark configuration. Nothing sizes itself to the
local machine: shuffle width, file split size and broadcast threshold are the
knobs a cluster operator tunes for the data at hand, and AQE re-plans them at
run time from real shuffle statistics.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings results depend on: date/timestamp semantics must not depend on
# the machine the driver runs on. Always applied.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Tuning defaults, applied when the engine builds the session (a caller's
# own session keeps its settings unless it asks for these):
#  * ANSI stays on (Spark 4 default); text parsing uses the try_* family.
#  * AQE with skew-join splitting and partition coalescing: a hot employee or
#    activity key gets its shuffle partition split at run time instead of
#    landing in one task.
#  * Broadcast only behind Spark's size check: no explicit hint on tables that
#    grow with the data; the planner broadcasts a side only when its measured
#    (AQE) or estimated size is below the threshold, and falls back to a
#    shuffle join beyond it.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Runtime Bloom filters: a selective small side of a shuffle join prunes
    # the large side before its shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
}


# ST-10: a shutdown lets a trigger end and commit; a restarted query takes over.
STREAM_CONF = {
    "spark.streaming.stopGracefullyOnShutdown": "true",
    "spark.sql.streaming.stopActiveRunOnRestart": "true",
}


def build_session(master: str | None = None, app_name: str = "stridelake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    ``master`` and ``shuffle_partitions`` are only set when given: on a cluster
    they come from spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **TUNING_CONF, **STREAM_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark, tuning=True)
    return spark


def apply_defaults(spark: SparkSession, tuning: bool = False) -> SparkSession:
    """Apply the required settings (and, with ``tuning=True``, the tuning
    defaults) to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)  # results depend on it: a refusal is an error
    for key, value in (TUNING_CONF if tuning else {}).items():
        if spark.conf.isModifiable(key):  # static ones are the cluster's choice
            spark.conf.set(key, value)
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it), else from
    ``STRIDELAKE_CHECKPOINT_DIR``. With neither, a single-process session
    (tests) gets a temporary folder of its own; a cluster gets an error, since
    a machine's own folder would be lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or os.environ.get("STRIDELAKE_CHECKPOINT_DIR")
    if not root:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
        root = _LOCAL_ROOTS.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="stridelake-")
        _LOCAL_ROOTS[context.applicationId] = root
    spark.sparkContext.setCheckpointDir(root)
    return root


def cluster_conf(total_cores: int, advisory_mb: int = 128) -> dict[str, str]:
    """Starting point for a large cluster (pass as ``extra`` or to
    spark-submit): enough initial shuffle partitions for every core, AQE
    coalescing toward ``advisory_mb`` per partition, 256 MB scan splits, and
    skew splitting for partitions 5x the median and above 256 MB."""
    parts = str(max(200, 3 * int(total_cores)))
    return {
        "spark.sql.shuffle.partitions": parts,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": parts,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}MB",
        "spark.sql.files.maxPartitionBytes": "256MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    }
