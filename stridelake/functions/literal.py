"""Small fixed tables as JVM-only literal relations.

``spark.createDataFrame(list)`` builds a Python-backed RDD scan, which starts
Python workers on the executors just to read a handful of constant rows.
``literal_table`` expresses the same rows as literals exploded from a
one-row range: the plan stays in the JVM, and the optimizer folds it to a
local table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: Sequence[tuple[str, str]]) -> DataFrame:
    """``rows`` of Python values typed by ``schema`` = [(name, sql type), ...]."""
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, schema)]) for row in rows]
    if not structs:
        return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(t).alias(n) for n, t in schema])
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
