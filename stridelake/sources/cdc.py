"""Change-topic stream sources (SRC-1, SRC-9, SRC-10).

``read_cdc_stream`` returns broker records ``(value, topic, partition,
offset, timestamp)``:

* ``source="kafka"``: the Kafka source (needs the spark-sql-kafka package on
  the classpath); ``starting="earliest"`` replays the topic (Bronze),
  ``"latest"`` tails it (notifications); a lost offset is tolerated.
* ``source="landing"``: the file twin used where no broker exists (tests,
  replays): JSON-lines files holding the same five columns, read as a
  stream from a landing directory. A file source has no "start at the
  end" position: a new checkpoint reads what is already landed.

Progress lives in the streaming query's checkpoint, which replaces consumer
groups and manual commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S


def read_cdc_stream(spark: SparkSession, topics: str | list[str], source: str = "kafka",
                    bootstrap: str | None = None, starting: str = "earliest",
                    landing_path: str | None = None,
                    max_per_trigger: int | None = None) -> DataFrame:
    names = [topics] if isinstance(topics, str) else list(topics)
    if source == "kafka":
        if not bootstrap:
            raise ValueError("bootstrap servers are required for the kafka source")
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap)
                  .option("subscribe", ",".join(names))
                  .option("startingOffsets", starting)
                  .option("failOnDataLoss", "false"))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        raw = reader.load()
        return raw.select(F.col("value").cast("string").alias("value"), "topic",
                          F.col("partition").cast("int").alias("partition"),
                          F.col("offset").cast("long").alias("offset"), "timestamp")
    if source == "landing":
        if not landing_path:
            raise ValueError("landing_path is required for the landing source")
        reader = spark.readStream.schema(S.BROKER_RECORD)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
        raw = reader.json(landing_path)
        return raw.where(F.col("topic").isin(*names))
    raise ValueError(f"unknown source {source!r}")


def write_landing(records: DataFrame, landing_path: str) -> None:
    """Append broker records to a landing directory (test/replay twin of a
    producer)."""
    (records.select("value", "topic", "partition", "offset", "timestamp")
     .write.mode("append").json(landing_path))
