"""12-month activity kept up to date by retractions (AG-1, FL-3).

The state is a log of signed sums for each (employee, day): what a batch of
changes takes back (the old images) and what it adds (the new ones). A view at a
date is the sum of the log's days inside the window; moving on from an earlier
view adds the batch's sums and subtracts the days that leave the window, so a
step reads the batch, the leaving days and one row per employee, not the
activities. An activity that changes its employee, day or distance, or is
deleted, is taken back with the image it was added with.

Views are as of the start of a day, so that a day is inside the window or not.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.literal import literal_table
from ..sinks.lake import write_log_partition
from ..sources.files import finished, names, newest, numbered
from .benefits import activity_totals_view, window_start
from .changes import is_live

METRES = "decimal(38,6)"
DAYS = [("employee_id", "bigint"), ("day", "date"), ("n", "bigint"), ("metres", METRES)]
TOTALS = [("employee_id", "bigint"), ("n", "bigint"), ("metres", METRES)]


def _midnight(as_of: str | _dt.date) -> str:
    text = str(as_of)
    if text[10:].strip(" T0:.") or len(text) < 10:
        raise ValueError(f"a view is as of the start of a day, not {text}")
    return text[:10]


def first_day(as_of: str | _dt.date) -> Column:
    """The first day inside the window of ``as_of``."""
    return F.to_date(window_start(_midnight(as_of)))


def activity_deltas(changes: DataFrame, start: str = "start_at") -> DataFrame:
    """Signed sums of ``(activity_id, old, new)``: one row for each (employee,
    day) that gains or loses something. A null distance counts as none."""
    def image(side: str, sign: int) -> Column:
        metres = F.coalesce(F.col(f"{side}.distance_m"), F.lit(0)).cast(METRES)
        return F.when(is_live(side), F.struct(
            F.col(f"{side}.employee_id").cast("long").alias("employee_id"), F.to_date(F.col(f"{side}.{start}")).alias("day"),
            F.lit(sign).cast("long").alias("n"), (metres * sign).cast(METRES).alias("metres")))

    sides = F.filter(F.array(image("old", -1), image("new", 1)), lambda x: x.isNotNull())
    return _summed(changes.select(F.inline(sides)))


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    keys = keys or ("employee_id", "day")
    return (rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("metres").cast(METRES).alias("metres"))
            .where((F.col("n") != 0) | (F.col("metres") != 0)))


def day_sums(log: DataFrame) -> DataFrame:
    """The state of a log of deltas: (employee_id, day, n, metres)."""
    return _summed(log.select("employee_id", "day", "n", "metres"))


def totals_at(log: DataFrame, as_of) -> DataFrame:
    """Employees with activity in the window of ``as_of``, from the whole log."""
    return _summed(log.where(F.col("day") >= first_day(as_of)).select("employee_id", "n", "metres"), "employee_id")


def advance_totals(totals: DataFrame, log: DataFrame, deltas: DataFrame, previous, as_of) -> DataFrame:
    """``totals`` at ``previous`` moved on to ``as_of``: plus ``deltas``, minus
    the days of ``log`` (the state before ``deltas``) that leave the window."""
    if _midnight(as_of) < _midnight(previous):
        raise ValueError("a window moves forward only")
    leaving = (log.where((F.col("day") >= first_day(previous)) & (F.col("day") < first_day(as_of)))
               .select("employee_id", (-F.col("n")).alias("n"), (-F.col("metres")).cast(METRES).alias("metres")))
    arriving = deltas.where(F.col("day") >= first_day(as_of)).select("employee_id", "n", "metres")
    return _summed(totals.unionByName(leaving).unionByName(arriving), "employee_id")


class RollingActivity:
    """The log and the newest totals under ``root``, one step for each batch.

    ``<root>/days/batch_id=<n>`` holds a batch's deltas, ``<root>/totals/v<n>``
    the totals after it with the date they are as of. Replaying a finished batch
    returns its totals; one that died midway starts again from the totals before
    it and replaces its own partition."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, before: int) -> DataFrame:
        if not names(self.spark, f"{self.root}/days"):
            return literal_table(self.spark, [], DAYS)
        return self.spark.read.parquet(f"{self.root}/days").where(F.col("batch_id") < before).select("employee_id", "day", "n", "metres")

    def _totals(self, name: str) -> tuple[DataFrame, str]:
        return (self.spark.read.parquet(f"{self.root}/totals/{name}"),
                self.spark.read.text(f"{self.root}/as_of/{name}").first()[0])

    def apply(self, changes: DataFrame, batch_id: int, as_of) -> DataFrame:
        """Fold a batch of ``(activity_id, old, new)``; returns the new totals."""
        if finished(self.spark, f"{self.root}/totals/{numbered(batch_id)}"):
            return self._totals(numbered(batch_id))[0]
        before = newest(self.spark, f"{self.root}/totals", below=numbered(batch_id))
        write_log_partition(activity_deltas(changes), f"{self.root}/days", batch_id)
        deltas = (self.spark.read.schema("employee_id long, day date, n long, metres " + METRES)
                  .parquet(f"{self.root}/days/batch_id={batch_id}") if self._wrote(batch_id)
                  else literal_table(self.spark, [], DAYS))
        if before:
            totals, previous = self._totals(before)
            after = advance_totals(totals, self._log(batch_id), deltas, previous, as_of)
        else:
            after = totals_at(deltas, as_of)
        number = numbered(batch_id)
        literal_table(self.spark, [(_midnight(as_of),)], [("value", "string")]).write.mode("overwrite").text(f"{self.root}/as_of/{number}")
        after.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.root}/totals/{number}")
        return self.spark.read.parquet(f"{self.root}/totals/{number}")

    def _wrote(self, batch_id: int) -> bool:
        return f"batch_id={batch_id}" in names(self.spark, f"{self.root}/days")

    def totals(self) -> DataFrame:
        last = newest(self.spark, f"{self.root}/totals")
        return self._totals(last)[0] if last else literal_table(self.spark, [], TOTALS)

    def view(self, employees: DataFrame) -> DataFrame:
        """AG-1's columns for every employee, from the newest totals."""
        return activity_totals_view(employees, self.totals().select(
            "employee_id", F.col("n").alias("_n"), F.col("metres").alias("_m")))
