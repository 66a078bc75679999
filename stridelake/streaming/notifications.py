"""Notification stream (ST-9, SNK-12): tail the change topic, keep live
activities, build the congratulation text, append it to a notifications
table (one partition per micro-batch, replay-safe). Malformed records go to
a side table instead of being silently skipped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.cdc import decode_cdc, malformed
from ..operators.notify import notifications
from ..sinks.lake import write_log_partition
from .control import checkpoint_for


def start_notifications(records: DataFrame, out_path: str, malformed_path: str, checkpoint: str | None,
                        load_employees: Callable[[SparkSession], DataFrame],
                        fmt: str = "parquet", trigger: dict | None = None,
                        query_name: str = "live_notifications"):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        decoded = decode_cdc(batch).persist()
        try:
            write_log_partition(notifications(decoded, load_employees(spark), reduce_references=True),
                                out_path, batch_id, fmt)
            write_log_partition(malformed(decoded), malformed_path, batch_id, fmt)
        finally:
            decoded.unpersist()

    return (records.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint_for(records.sparkSession, query_name, checkpoint))
            .queryName(query_name)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .start())
