"""Activity intake (V-1..V-3, SNK-13, LM-1, PR-10).

The reference validates one HTTP request at a time; here a batch of
submitted activities is split into accepted rows (stamped ``source='live'``)
and rejected rows with the first failing reason, in the order the API
checks them: field rules (V-3), then ``end_at > start_at`` (V-1), then the
employee must exist (V-2). ``accepted`` and ``rejected`` partition the input.
The existence check joins the batch only to its own unknown keys
(``operators.keys``), never the whole employee table to the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from .keys import flag_unknown_key

REQUIRED = ["employee_id", "start_at", "end_at", "sport_type"]


def validate_intake(batch: DataFrame, employees: DataFrame) -> DataFrame:
    """Every submitted row with ``reject_reason`` (NULL when accepted)."""
    missing = None
    for c in REQUIRED:
        cond = F.col(c).isNull()
        missing = cond if missing is None else (missing | cond)
    pre = (F.when(missing, F.lit(K.REJECT_MISSING_FIELD))
           .when(F.length("sport_type") < 1, F.lit(K.REJECT_EMPTY_SPORT))
           .when(F.col("distance_m") < 0, F.lit(K.REJECT_NEGATIVE_DISTANCE))
           .when(F.col("end_at") <= F.col("start_at"), F.lit(K.REJECT_END_BEFORE_START)))
    flagged = flag_unknown_key(batch.withColumn("_pre", pre), employees, "employee_id")
    return (flagged
            .withColumn("reject_reason",
                        F.coalesce(F.col("_pre"),
                                   F.when(F.col("_unknown"), F.lit(K.REJECT_UNKNOWN_EMPLOYEE))))
            .drop("_pre", "_unknown"))


def accepted(validated: DataFrame, created_at=None) -> DataFrame:
    """SNK-13: rows to insert, stamped as live activities, in the shape of the
    activities table; ``created_at`` defaults to now."""
    stamp = F.current_timestamp() if created_at is None else (
        created_at if isinstance(created_at, Column) else F.lit(str(created_at)).cast("timestamp"))
    return (validated.where(F.col("reject_reason").isNull())
            .select("activity_id", "employee_id", "start_at", "end_at", "sport_type",
                    "distance_m", "comment", F.lit(K.LIVE_SOURCE).alias("source"),
                    stamp.alias("created_at")))


def rejected(validated: DataFrame) -> DataFrame:
    return (validated.where(F.col("reject_reason").isNotNull())
            .select("activity_id", "employee_id", "reject_reason"))


def recent_activities(activities: DataFrame, limit: int = 10) -> DataFrame:
    """LM-1 / PR-10: the ``limit`` newest activities by id (clamped to
    [1, 100]); distance as a float, NULL kept. Top-k is taken per partition
    and merged (TakeOrderedAndProject): at most ``k`` rows per task move."""
    k = max(1, min(int(limit), 100))
    return (activities
            .select("activity_id", "employee_id", "start_at", "end_at", "sport_type",
                    F.col("distance_m").cast("double").alias("distance_m"),
                    "comment", "source", "created_at")
            .orderBy(F.col("activity_id").desc())
            .limit(k))

