"""Silver stream (ST-2, ST-3, SNK-2, SNK-4).

Per micro-batch (``foreachBatch``):
1. re-read the employee and sport references, so a new snapshot is used
   from the next batch on without a restart (stream-static join);
2. enrich the Bronze rows and write them into the Silver log's
   ``batch_id`` partition with dynamic overwrite - a replayed batch replaces
   its own partition, never duplicates it;
3. optionally upsert the serving projection of *the written partition*
   (read back, so the log and the serving table hold the same stamp and the
   plan is not evaluated twice) into a JDBC table, newest version per key.

Records without a usable payload go to ``malformed_path`` if one is given.
With ``pinned`` a replayed batch reads the reference versions it read before;
with ``current_root`` each batch is merged into a keyed table that rewrites only
the dates it touches.

The current state of the lake is ``compact_current``: latest version per
activity over the whole log, written to a new directory (never over a path
the same plan reads). ``publish_current`` does the same step by step: it merges
the version published last with the batches after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.cdc import current_state, latest_by_key, malformed, only_valid
from ..operators.silver import enrich
from ..sinks import jdbc as J
from ..sinks.keyed import KeyedTable
from ..sinks.lake import KEPT_ENTRIES, write_log_partition
from ..functions.literal import literal_table
from ..sources.files import keep_newest, newest, numbered
from ..sources.reference import PinnedReferences
from ..sources.tables import ensure_table, read_table, read_table_stream
from .control import checkpoint_for


def make_batch_writer(silver_path: str,
                      load_employees: Callable[[SparkSession], DataFrame],
                      load_sports: Callable[[SparkSession], DataFrame],
                      fmt: str = "parquet", serving_jdbc: dict | None = None,
                      malformed_path: str | None = None, pinned: PinnedReferences | None = None,
                      current_root: str | None = None):
    """``pinned``: the loaders get the files of the reference versions that the
    batch read first, as a second argument. ``current_root``: a keyed table of
    the current state that each batch is merged into (``sinks.keyed``)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The batch is read twice (rows, and its keys to cut the references):
        # keep it for the duration of the write (memory and disk; a lost
        # block is recomputed from this batch's files).
        decoded = batch.persist()
        try:
            rows = only_valid(decoded)
            if pinned:
                files = pinned.files(spark, batch_id)
                references = load_employees(spark, files["employees"]), load_sports(spark, files["sports"])
            else:
                references = load_employees(spark), load_sports(spark)
            enriched = enrich(rows, *references, reduce_references=True)
            written = write_log_partition(enriched, silver_path, batch_id, fmt)
            if malformed_path:
                write_log_partition(malformed(decoded), malformed_path, batch_id, fmt)
        finally:
            decoded.unpersist()
        if not written:
            return
        # Only this batch's own directory is listed and read.
        own = spark.read.format(fmt).load(f"{silver_path.rstrip('/')}/batch_id={int(batch_id)}")
        if current_root:
            table = KeyedTable(spark, current_root, own.schema, fmt=fmt)
            table.upsert(own)
            if batch_id % KEPT_ENTRIES == KEPT_ENTRIES - 1:
                table.expire(KEPT_ENTRIES)
        if serving_jdbc:
            J.upsert_serving(own, serving_jdbc["url"], serving_jdbc["table"], serving_jdbc["staging"],
                             serving_jdbc.get("versions", False), serving_jdbc.get("props"),
                             serving_jdbc.get("probe_query", "SELECT 1 AS ok"))
    return write_batch


def start_silver(spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str | None,
                 load_employees: Callable[[SparkSession], DataFrame],
                 load_sports: Callable[[SparkSession], DataFrame],
                 fmt: str = "parquet", trigger: dict | None = None,
                 serving_jdbc: dict | None = None, query_name: str = "silver_activities",
                 malformed_path: str | None = None, pinned: PinnedReferences | None = None,
                 current_root: str | None = None):
    ensure_table(spark, bronze_path, S.BRONZE, fmt)
    bronze = read_table_stream(spark, bronze_path, S.BRONZE, fmt)
    w = (bronze.writeStream
         .foreachBatch(make_batch_writer(silver_path, load_employees, load_sports, fmt, serving_jdbc,
                                         malformed_path, pinned, current_root))
         .option("checkpointLocation", checkpoint_for(spark, query_name, checkpoint))
         .queryName(query_name)
         .trigger(**(trigger or {"processingTime": "0 seconds"})))
    return w.start()


def compact_current(spark: SparkSession, silver_path: str, out_path: str, fmt: str = "parquet") -> None:
    """Latest Silver row per activity over the whole log, deleted
    activities removed, written as a new version directory partitioned by
    ``activity_date`` (date-bounded queries prune partitions). Read it with
    ``read_table``; ``serving_projection`` / ``as_activities`` give the
    published and domain shapes."""
    log = read_table(spark, silver_path, fmt).drop("batch_id")
    # Range-partition on (date, id): few files per date, and a date holding a
    # large share of the rows is still split across many writer tasks.
    (current_state(log).repartitionByRange("activity_date", "activity_id")
     .write.format(fmt).mode("errorifexists").partitionBy("activity_date").save(out_path))


def publish_current(spark: SparkSession, silver_path: str, current_root: str, version: int,
                    fmt: str = "parquet") -> str:
    """Write ``<current_root>/v<version>`` and then register it in
    ``<current_root>/_versions/v<version>`` (a reader takes the newest finished
    entry by name, so it sees either the previous or the new version, never a
    partial one). Older versions stay readable until removed by retention.

    Incremental: the last published version and the log batches after the one
    it reached are merged, newest change per key; the rest of the log is not
    read. Keys whose newest change is a delete stay inside a version (so that a
    late, older change cannot bring them back) and are left out on reading.
    """
    root = current_root.rstrip("/")
    out = f"{root}/v{int(version)}"
    log = read_table(spark, silver_path, fmt)
    last = _last_version(spark, root)
    if last:
        log = log.where(F.col("batch_id") > F.lit(last["batch_id"]))
    reached = log.agg(F.max("batch_id")).first()[0]
    changes = only_valid(log.drop("batch_id"))
    if last:
        changes = read_table(spark, last["path"], fmt).select(*changes.columns).unionByName(changes)
    (latest_by_key(changes, "activity_id").repartitionByRange("activity_date", "activity_id")
     .write.format(fmt).mode("errorifexists").partitionBy("activity_date").save(out))
    reached = max(x for x in (reached, last and last["batch_id"], -1) if x is not None)
    (literal_table(spark, [(int(version), out, int(reached))],
                   [("version", "bigint"), ("path", "string"), ("batch_id", "bigint")])
     .coalesce(1).write.mode("overwrite").parquet(f"{root}/_versions/{numbered(int(version))}"))
    keep_newest(spark, f"{root}/_versions", KEPT_ENTRIES)
    return out


def _last_version(spark: SparkSession, root: str):
    """The newest entry of the version log (one row), None without one."""
    last = newest(spark, f"{root}/_versions")
    return spark.read.parquet(f"{root}/_versions/{last}").first() if last else None


def read_current(spark: SparkSession, current_root: str, fmt: str = "parquet") -> DataFrame:
    """The newest published current-state version, deleted keys left out."""
    last = _last_version(spark, current_root.rstrip("/"))
    if not last:
        raise FileNotFoundError(f"no published version under {current_root}")
    rows = read_table(spark, last["path"], fmt)
    return rows.where(F.col("__op").isNull() | (F.col("__op") != "d"))
