"""Bronze stream (ST-1, ST-6, ST-8, ST-11): change topic -> decoded,
append-only lake table. Every record is kept, malformed ones as all-NULL
business rows with their broker coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cdc import decode_cdc
from ..sinks.lake import append_stream
from .control import checkpoint_for


def bronze_frame(records: DataFrame, keep_unknown: bool = False) -> DataFrame:
    return decode_cdc(records, keep_unknown=keep_unknown)


def once(records: DataFrame, within: str) -> DataFrame:
    """Broker records without those delivered again: one for each (topic,
    partition, offset) while copies come within ``within`` of each other by
    broker time. The state holds the coordinates of that span only; a record
    without a time is left out, since no watermark ever covers it."""
    return (records.where(F.col("timestamp").isNotNull()).withWatermark("timestamp", within)
            .dropDuplicatesWithinWatermark(["topic", "partition", "offset"]))


def start_bronze(records: DataFrame, path: str, checkpoint: str | None = None, fmt: str = "parquet",
                 trigger: dict | None = None, query_name: str = "bronze_activities",
                 once_within: str | None = None, keep_unknown: bool = False):
    """SNK-1: start the Bronze append stream (``trigger={"availableNow": True}``
    for a bounded catch-up run). ``once_within``: drop records that the broker
    delivers again within that span; ``keep_unknown``: keep undeclared payload
    fields."""
    records = once(records, once_within) if once_within else records
    checkpoint = checkpoint_for(records.sparkSession, query_name, checkpoint)
    return append_stream(bronze_frame(records, keep_unknown), path, checkpoint, fmt=fmt, trigger=trigger,
                         query_name=query_name)
