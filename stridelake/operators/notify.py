"""Live-activity notifications (FL-1, JN-11, SC-5, SC-14, SC-15, SNK-12).

Each live change event becomes one congratulation text. The employee name
is looked up with a left join (the reference opens one database connection
per event); an unknown employee is named ``Employé <id>``. The text is
assembled with native string functions; the HTTP post itself is not part of
the engine (the output is a table a delivery job can read).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import km_text_1dp, parse_iso_ts, py_strip, whole_minutes_half_even
from .keys import one_per_key, rows_for_keys


def live_only(events: DataFrame) -> DataFrame:
    """FL-1: events whose source is live, whatever their operation (a NULL
    source is dropped)."""
    return events.where(F.col("source") == F.lit(K.LIVE_SOURCE))


def _ts(c: str) -> Column:
    return parse_iso_ts(F.col(c).cast("string"))


def message(name: Column) -> Column:
    """SC-14: the notification text of the current row."""
    sport = F.coalesce(F.nullif(F.col("sport_type"), F.lit("")), F.lit(K.NOTIFY_DEFAULT_SPORT))
    start, end = _ts("start_at"), _ts("end_at")
    distance = F.when(F.col("distance_m").isNotNull() & sport.isin(*K.DISTANCE_SPORTS),
                      F.concat(F.lit(K.NOTIFY_DISTANCE_PREFIX), km_text_1dp("distance_m"),
                               F.lit(K.NOTIFY_DISTANCE_SUFFIX)))
    minutes = F.when(start.isNotNull() & end.isNotNull(),
                     F.concat(F.lit(K.NOTIFY_DURATION_PREFIX),
                              whole_minutes_half_even(start, end).cast("string"),
                              F.lit(K.NOTIFY_DURATION_SUFFIX)))
    comment = py_strip(F.coalesce(F.col("comment"), F.lit("")))
    comment_part = F.when((comment != F.lit("")) & ~comment.isin(*K.IGNORED_COMMENTS),
                          F.concat(F.lit(K.NOTIFY_COMMENT_PREFIX), comment, F.lit(K.NOTIFY_COMMENT_SUFFIX)))
    return F.concat(
        F.lit(K.NOTIFY_PREFIX), name, F.lit(K.NOTIFY_MIDDLE), sport,
        F.coalesce(distance, F.lit("")), F.coalesce(minutes, F.lit("")),
        F.lit(K.NOTIFY_END), F.coalesce(comment_part, F.lit("")),
    )


def notifications(events: DataFrame, employees: DataFrame, reduce_references: bool = False) -> DataFrame:
    """SNK-12: ``(activity_id, employee_id, __op, kafka_offset, message)`` for
    every live event of ``events`` (decoded change records).

    ``reduce_references`` (streaming, with the decoded batch persisted): the
    employee table is first cut to the ids present in the batch, so it is
    filtered rather than shuffled on every trigger."""
    # One name per employee (the lookup returns a single row per id).
    names = employees.select(F.col("employee_id").cast("long").alias("_eid"),
                             F.col("first_name").alias("_fn"), F.col("last_name").alias("_ln"))
    live = live_only(events)
    if reduce_references:   # cut first: only the batch's employees are aggregated
        names = rows_for_keys(names, "_eid", live.select(F.col("employee_id").cast("long").alias("_k")), "_k")
    names = one_per_key(names, "_eid")
    joined = live.join(names, F.col("employee_id").cast("long") == F.col("_eid"), "left")
    # Python renders a missing name part as "None".
    name = F.when(F.col("_eid").isNotNull(),
                  F.concat(F.coalesce(F.col("_fn"), F.lit("None")), F.lit(" "),
                           F.coalesce(F.col("_ln"), F.lit("None"))))
    unknown = F.concat(F.lit(K.NOTIFY_UNKNOWN_EMPLOYEE),
                       F.coalesce(F.col("employee_id").cast("string"), F.lit("None")))
    return joined.select("activity_id", "employee_id", "__op", "kafka_offset",
                         message(F.coalesce(name, unknown)).alias("message"))
