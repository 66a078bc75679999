"""Stream lifecycle helpers (ST-11). Graceful stop (ST-10) is a session
setting: ``spark.sql.streaming.stopActiveRunOnRestart`` and
``spark.streaming.stopGracefullyOnShutdown`` in ``session.STREAM_CONF``.

Checkpoints live under the shared folder the cluster names in
``spark.checkpoint.dir`` unless a location is given; a restarted query
resumes from its checkpoint, so a lost executor or driver costs a retry, not
duplicates.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import checkpoint_root


def checkpoint_for(spark: SparkSession, name: str, given: str | None = None) -> str:
    """``given`` or ``<spark.checkpoint.dir>/streams/<name>``."""
    if given:
        return given
    return f"{checkpoint_root(spark).rstrip('/')}/streams/{name}"
