"""The one CSV dialect of the engine's files: header, UTF-8, doubled quotes.

NULL is an empty cell and empty text a quoted one, and no white space is
trimmed, so a written table reads back cell for cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CSV_FORMAT = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"', "nullValue": "",
              "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: Stands for a quoted empty cell while it is read: the reader would take empty text for NULL.
_EMPTY = "\x01"


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the files as text; cells may hold line breaks."""
    raw = spark.read.options(**CSV_FORMAT).option("emptyValue", _EMPTY).option("multiLine", "true").csv(path)
    return raw.select(*[F.when(F.col(f"`{c}`") == _EMPTY, "").otherwise(F.col(f"`{c}`")).alias(c)
                        for c in raw.columns])
