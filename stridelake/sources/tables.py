"""Lakehouse tables as batch and stream sources (SRC-2, SRC-3, SRC-6).

The table format is an argument: ``parquet`` by default, ``delta`` (or any
other format on the classpath) where its jar is present.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.literal import literal_table

DEFAULT_FORMAT = "parquet"


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT,
               schema: StructType | None = None) -> DataFrame:
    """SRC-6: batch scan of a lake table (filters and column pruning reach
    the scan through Catalyst)."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt not in ("delta",):
        reader = reader.schema(schema)
    return reader.load(path)


def table_exists(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> bool:
    try:
        spark.read.format(fmt).load(path).schema
        return True
    except AnalysisException:
        return False


def ensure_table(spark: SparkSession, path: str, schema: StructType,
                 fmt: str = DEFAULT_FORMAT, partition_by: list[str] | None = None) -> None:
    """SRC-3: make sure the upstream table exists before a stream starts
    (replaces a poll-and-sleep loop): create it empty with the declared
    schema when missing."""
    if table_exists(spark, path, fmt):
        return
    empty = literal_table(spark, [], [(f.name, f.dataType.simpleString()) for f in schema.fields])
    writer = empty.write.format(fmt).mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_table_stream(spark: SparkSession, path: str, schema: StructType,
                      fmt: str = DEFAULT_FORMAT, max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-2: a lake table as an unbounded stream (declared schema, never
    inferred)."""
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
