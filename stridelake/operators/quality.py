"""Data-quality rules DQ01..DQ08 and the per-rule summary (AG-3, SET-1).

Activities are flagged with "unknown employee" first (their distinct keys are
anti-joined with the employee keys; the usually tiny set of unknown ids is
joined back and broadcast when its measured size allows, so the activity table
is not shuffled in full), then all eight rules are evaluated in one pass: an
array of optional findings, exploded. Output multiplicity is UNION ALL: an
activity yields 0..8 findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import is_blank_sql
from .keys import flag_unknown_key


def _ts(value) -> Column:
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def _finding(rule: str, cond: Column, message: Column | str) -> Column:
    msg = message if isinstance(message, Column) else F.lit(message)
    return F.when(cond, F.struct(F.lit(rule).alias("rule_name"), msg.alias("error_message")))


def row_rules(as_of=None) -> list[Column]:
    """The rules as optional (rule_name, error_message) structs; DQ04 reads the
    flag ``_unknown``."""
    d, s = F.col("distance_m"), F.col("sport_type")
    return [
        _finding(K.DQ01, d < 0, K.DQ01_MESSAGE),
        _finding(K.DQ02, F.col("end_at") <= F.col("start_at"), K.DQ02_MESSAGE),
        _finding(K.DQ03, is_blank_sql(s), K.DQ03_MESSAGE),
        _finding(K.DQ04, F.col("_unknown"), K.DQ04_MESSAGE),
        _finding(K.DQ05, F.col("start_at") > _ts(as_of), K.DQ05_MESSAGE),
        _finding(K.DQ06, d.isNotNull() & s.isin(*K.NON_DISTANCE_SPORTS),
                 F.concat(F.lit(K.DQ06_PREFIX), s, F.lit("."))),
        _finding(K.DQ07, d.isNull() & s.isin(*K.DISTANCE_SPORTS),
                 F.concat(F.lit(K.DQ07_PREFIX), s, F.lit("."))),
        _finding(K.DQ08, s == F.lit(K.MISSPELLED_SPORT), K.DQ08_MESSAGE),
    ]


def dq_results(activities: DataFrame, employees: DataFrame, as_of=None,
               detected_at=None) -> DataFrame:
    """All findings ``(activity_id, employee_id, rule_name, error_message,
    detected_at)``. ``as_of`` is "now" for DQ05; ``detected_at`` defaults to it."""
    stamp = _ts(detected_at if detected_at is not None else as_of)
    flagged = flag_unknown_key(
        activities.select("activity_id", "employee_id", "start_at", "end_at", "sport_type", "distance_m"),
        employees, "employee_id")
    findings = F.filter(F.array(*row_rules(as_of)), lambda x: x.isNotNull())
    return (flagged
            .select("activity_id", "employee_id", F.inline(findings))
            .select("activity_id", "employee_id", "rule_name", "error_message",
                    stamp.alias("detected_at")))


def dq_summary(results: DataFrame) -> DataFrame:
    """AG-3: findings per rule; rules without findings are absent."""
    return results.groupBy("rule_name").agg(F.count(F.lit(1)).alias("anomaly_count"))


def rows_to_judge(activities: DataFrame, changed: DataFrame, moved: DataFrame, previous, as_of,
                  key: str = "activity_id") -> DataFrame:
    """Keys whose findings may differ from those at ``previous``: changed
    activities, activities of the employees in ``moved`` (who came or went:
    DQ04) and those whose start lies between the two clocks (DQ05)."""
    low, high = F.least(_ts(previous), _ts(as_of)), F.greatest(_ts(previous), _ts(as_of))
    passed = (F.col("start_at") > low) & (F.col("start_at") <= high)
    if "activity_date" in activities.columns:     # prunes date partitions
        passed = passed & F.col("activity_date").between(F.to_date(low), F.to_date(high))
    of_moved = activities.join(moved.select("employee_id").distinct(), "employee_id", "left_semi").select(key)
    return changed.select(key).unionByName(activities.where(passed).select(key)).unionByName(of_moved).distinct()


def refresh_findings(findings: DataFrame, activities: DataFrame, employees: DataFrame, changed: DataFrame,
                     moved: DataFrame, previous, as_of, detected_at=None, key: str = "activity_id") -> DataFrame:
    """``findings`` (of the run at ``previous``) brought to ``as_of``: the rows
    of ``rows_to_judge`` are judged again, all other findings stay as they are,
    with the time they were found. ``activities`` and ``employees`` are the
    current tables, ``changed`` the keys that changed since (deleted ones
    included), ``moved`` the employees who came or went.

    Two-sided: a rule can start or stop to hold through the activity, through
    the employee table or through the clock. Only the judged rows and their
    employees' keys go through the rules; the activity table is scanned for its
    keys, cut by the semi joins, not shuffled."""
    judged = rows_to_judge(activities, changed, moved, previous, as_of, key)
    again = dq_results(activities.join(judged, key, "left_semi"), employees, as_of, detected_at)
    return findings.join(judged, key, "left_anti").select(*again.columns).unionByName(again)


def came_or_went(before: DataFrame, after: DataFrame, key: str = "employee_id") -> DataFrame:
    """Keys in one of two versions of a reference table only."""
    old, new = before.select(key).distinct(), after.select(key).distinct()
    return old.join(new, key, "left_anti").unionByName(new.join(old, key, "left_anti"))
