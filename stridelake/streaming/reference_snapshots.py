"""Reference snapshots (ST-4, SET-2, SRC-8, SNK-7).

Change records on the reference topics only signal that a table changed. A
snapshot re-reads the changed table in full, ordered by key, and publishes it:
immutable timestamped archive first, then the current copy.

``quiet_topics`` is a trailing-edge debounce: a topic's records form sessions,
and a session ends, and fires, once the topic has been quiet for the debounce
time, however long the burst was. A heartbeat moves the clock on when no record
comes. Without it (``trailing=False``, catch-up runs that end) each trigger
interval collects the topics of its micro-batch, so a burst over several
intervals gives several snapshots with the same final state.

The set of distinct topics is bounded by the configured tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.lake import publish_reference, snapshot_stamp
from .control import checkpoint_for


def quiet_topics(records: DataFrame, quiet_seconds: float = 2.0) -> DataFrame:
    """``(topic, last_at, changes)`` of every burst that has been over for
    ``quiet_seconds``, by arrival time. State: one session for each topic.

    Arrival times only grow, so nothing is late. The heartbeat's own session
    never ends; it is told apart by an aggregate, since a condition on the topic
    would be pushed down to the records and stop the clock."""
    spark = records.sparkSession
    arrived = records.select("topic", F.current_timestamp().alias("at"), F.lit(1).alias("record"))
    beats = (spark.readStream.format("rate").option("rowsPerSecond", "1").option("numPartitions", "1").load()
             .select(F.lit(None).cast("string").alias("topic"), F.col("timestamp").alias("at"), F.lit(0).alias("record")))
    sessions = (arrived.unionByName(beats).withWatermark("at", "0 seconds")
                .groupBy(F.session_window("at", f"{int(quiet_seconds * 1000)} milliseconds").alias("w"), "topic")
                .agg(F.max("at").alias("last_at"), F.sum("record").alias("changes")))
    return sessions.where(F.col("changes") > 0).select("topic", "last_at", "changes")


def start_reference_snapshots(records: DataFrame, tables: dict[str, dict], checkpoint: str | None,
                              debounce_seconds: float = 2.0,
                              read: Callable[[SparkSession, dict], DataFrame] | None = None,
                              trigger: dict | None = None, query_name: str = "reference_snapshots",
                              trailing: bool = False):
    """``tables``: topic -> {"archive_prefix", "current_path", "order_by", and
    what ``read(spark, cfg)`` needs to re-read the table}. ``trailing``: publish
    once a topic has been quiet for ``debounce_seconds``."""
    if trailing:
        records = quiet_topics(records.where(F.col("topic").isin(*tables)), debounce_seconds)
        trigger = trigger or {"processingTime": f"{debounce_seconds / 4} seconds"}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = [r.topic for r in batch.select("topic").where(F.col("topic").isin(*tables))
                   .distinct().collect()]
        for topic in sorted(changed):
            cfg = tables[topic]
            df = read(spark, cfg).orderBy(cfg["order_by"])
            publish_reference(df, cfg["archive_prefix"], cfg["current_path"], snapshot_stamp(),
                              cfg["order_by"])

    return (records.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint_for(records.sparkSession, query_name, checkpoint))
            .queryName(query_name)
            .trigger(**(trigger or {"processingTime": f"{debounce_seconds} seconds"}))
            .start())
