"""Reference and master-data files (SRC-4, SRC-5, SRC-7, SRC-8).

CSV files are read with a declared all-text schema (never inferred), header
on, UTF-8 (Spark drops a UTF-8 byte-order mark from the header), and then
typed by name with non-raising casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.csv import read_csv_text
from ..functions.exprs import text_to_int
from ..functions.literal import literal_table
from ..operators.master import clean_employees, clean_sports
from .files import finished, newest, numbered


def current_files(spark: SparkSession, path: str) -> str:
    """The newest version that ``publish_reference`` registered under ``path``,
    found by name; a path without versions is read as it is."""
    log = f"{path.rstrip('/')}/_versions"
    last = newest(spark, log)
    return spark.read.parquet(f"{log}/{last}").first()["path"] if last else path


class PinnedReferences:
    """Which reference version a batch read: chosen when the batch runs first
    (the newest of each reference), written to ``<log>/v<batch>`` and read from
    there by every replay, so a replay after a new snapshot gives the same rows."""

    def __init__(self, log: str, references: dict[str, str]):
        """``references``: name -> path as ``publish_reference`` writes it."""
        self.log, self.references = log.rstrip("/"), references

    def files(self, spark: SparkSession, batch_id: int) -> dict[str, str]:
        """Name -> files of the version pinned for the batch."""
        at = f"{self.log}/{numbered(batch_id)}"
        if not finished(spark, at):
            rows = [(name, current_files(spark, path)) for name, path in sorted(self.references.items())]
            literal_table(spark, rows, [("name", "string"), ("path", "string")]).coalesce(1).write.mode("overwrite").parquet(at)
        return {r["name"]: r["path"] for r in spark.read.parquet(at).collect()}


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_text(spark, current_files(spark, path))


def read_employees_ref(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: employee reference as Silver uses it (columns by name)."""
    raw = _csv(spark, path)
    return raw.select(
        text_to_int("employee_id", "long").alias("employee_id"),
        "first_name", "last_name", "business_unit", "contract_type",
        F.col("annual_gross_salary").try_cast(S.SALARY).alias("annual_gross_salary"),
    )


def read_sports_ref(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: sport reference as Silver uses it."""
    raw = _csv(spark, path)
    return raw.select(text_to_int("employee_id", "long").alias("employee_id"), "sport")


def load_employees(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: master employee CSV with every cell cleaned (SC-9..SC-11)."""
    return clean_employees(_csv(spark, path))


def load_sports(spark: SparkSession, path: str) -> DataFrame:
    return clean_sports(_csv(spark, path))


def read_reference(spark: SparkSession, fmt: str, order_by: str, path: str | None = None,
                   options: dict[str, str] | None = None) -> DataFrame:
    """SRC-8: full re-read of a reference table, ordered by its key
    (``fmt="jdbc"`` with ``options`` such as url/dbtable, or a lake format
    with ``path``). The ordering is a range-partitioned sort."""
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path) if path else reader.load()
    return df.orderBy(order_by)


def key_ranges(keys: DataFrame, key: str, ranges: int) -> list[str]:
    """SQL conditions that deal the rows of a table out by ``key``, each row to
    one of them: bounds at the quantiles of ``keys``, so that uneven keys give
    even ranges; the outer ranges are open, null keys go with the first. Integer
    keys (``ranges`` numbers reach the driver)."""
    shares = [i / ranges for i in range(1, ranges)]
    found = keys.select(F.percentile_approx(F.col(key), shares, 10_000).alias("b")).first()["b"] if shares else None
    bounds = sorted({int(b) for b in found or []})
    if not bounds:
        return ["1 = 1"]
    inner = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(bounds, bounds[1:])]
    return [f"{key} < {bounds[0]} OR {key} IS NULL", *inner, f"{key} >= {bounds[-1]}"]


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, key: str, ranges: int = 32,
                     properties: dict[str, str] | None = None) -> DataFrame:
    """SRC-8: a database table read by ``ranges`` tasks, ordered by ``key``. One
    connection reads the keys alone for the bounds; then each task reads its
    range on a connection of its own."""
    properties = properties or {}
    keys = spark.read.jdbc(url, f"(SELECT {key} FROM {table}) key_column", properties=properties)
    conditions = key_ranges(keys, keys.columns[0], ranges)
    return spark.read.jdbc(url, table, predicates=conditions, properties=properties).orderBy(key)
