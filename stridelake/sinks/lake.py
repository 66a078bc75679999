"""Lake sinks (SNK-1, SNK-2, SNK-6, SNK-7, SNK-10, SNK-14).

Design rules:
* Replay-safe micro-batch writes: the Silver log is partitioned by
  ``batch_id`` and written with dynamic partition overwrite, so a replayed
  batch replaces its own partition instead of appending duplicates.
* No single-writer funnel: exports are globally sorted by a range-partitioned
  sort and written by all tasks (part files in key order), never
  ``coalesce(1)``.
* Reference snapshots are written to the archive first, and the current copy
  is produced from the archived files, so both are identical.
* Row counts come from ``Observation`` during the write (one pass).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.csv import CSV_FORMAT, read_csv_text
from ..functions.literal import literal_table
from ..sources.files import keep_newest

#: Entries that a log of published versions keeps.
KEPT_ENTRIES = 100


def append_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                  trigger: dict | None = None, partition_by: list[str] | None = None,
                  query_name: str | None = None):
    """SNK-1 / ST-1: append-only stream into a lake table with checkpointed
    progress (restart resumes where it stopped)."""
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "0 seconds"}))
    return w.start(path)


def write_log_partition(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> int:
    """SNK-2: write one micro-batch into its ``batch_id`` partition,
    replacing that partition on replay (idempotent). Returns the rows written."""
    obs = Observation("log_rows")
    (df.observe(obs, F.count(F.lit(1)).alias("rows"))
     .withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
     .write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").save(path))
    return int(obs.get["rows"])


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: list[str] | None = None) -> None:
    """SNK-10: truncate-and-recompute (e.g. the DQ results table). The path
    must not be one the plan reads."""
    w = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def observed_write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> int:
    """SNK-14: write and report the number of rows written, in one pass."""
    obs = Observation("rows_written")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode).save(path)
    return int(obs.get["rows"])


def export_bi_csv(silver: DataFrame, out: str, order_by: str = "activity_id") -> None:
    """SNK-6: BI export, 14 columns with header, globally sorted by
    ``order_by`` across ordered part files (written in parallel)."""
    (silver.select(*S.BI_COLUMNS).orderBy(order_by)
     .write.mode("overwrite").options(**CSV_FORMAT).csv(out))


def snapshot_stamp(now: _dt.datetime | None = None) -> str:
    """SC-24: UTC stamp ``YYYYMMDDTHHMMSSffffffZ`` of an archive version."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.astimezone(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def publish_reference(df: DataFrame, archive_prefix: str, current_path: str,
                      stamp: str | None = None, order_by: str | None = None) -> str:
    """SNK-7: immutable timestamped snapshot, then the current copy.

    Returns the archive path. The current copy is made from the archived cells
    (all text, so nothing is re-interpreted) in a directory of its own, and
    becomes current when its entry ``<current_path>/_versions/<stamp>`` is
    finished: a reader takes the newest finished entry by name, so it sees the
    version before or the new one, whole, and a failure leaves the one before.
    The newest ``KEPT_ENTRIES`` entries stay.
    """
    stamp = stamp or snapshot_stamp()
    archive = f"{archive_prefix}_{stamp}"
    df.write.mode("errorifexists").options(**CSV_FORMAT).csv(archive)
    spark = df.sparkSession
    archived = read_csv_text(spark, archive)
    if order_by:
        archived = archived.orderBy(F.col(order_by).try_cast(df.schema[order_by].dataType))
    current = f"{current_path.rstrip('/')}/{stamp}"
    archived.write.mode("overwrite").options(**CSV_FORMAT).csv(current)
    log = f"{current_path.rstrip('/')}/_versions"
    literal_table(spark, [(stamp, current)], [("stamp", "string"), ("path", "string")]).coalesce(1).write.mode("overwrite").parquet(f"{log}/{stamp}")
    keep_newest(spark, log, KEPT_ENTRIES)
    return archive


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, fmt: str = "parquet",
                  path: str | None = None, sort: bool = True) -> None:
    """Write ``df`` as a catalog table bucketed (and sorted) by ``key``.

    Tables bucketed on the same key with the same bucket count join and
    aggregate on that key without a shuffle: e.g. the compacted activities
    and the employee table, both bucketed by ``employee_id``, feed the
    12-month aggregation and the eligibility joins with no exchange. Choose
    ``buckets`` so each bucket file stays around 128-512 MB at the target
    size. ``path`` makes it an external table in the shared lake.

    Trade-off: a bucket is read by one task, so a key holding a large share
    of the rows makes its bucket a straggler that neither partial
    aggregation nor AQE can split. Bucket on keys without such skew; for a
    hot key keep the default plan (map-side partial aggregation, then a
    shuffle that AQE can split).
    """
    w = df.write.format(fmt).mode("overwrite").bucketBy(int(buckets), key)
    if sort:
        w = w.sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
