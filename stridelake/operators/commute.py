"""Commute validation (CM-1..CM-5, AG-5, JN-9, JN-12).

The reference walks employees one by one and calls a routing service. Here
the routing answers are an input table ``(employee_id, distance_m,
api_error)`` and the classification is one set-based pass: a join on the
employee key and a CASE chain. The two commute rules are a fixed CASE
expression, so they need neither a join nor a broadcast. The km value is
``round(m / 1000, 2)`` with Python's rounding (the validation was a Python
job), compared with the threshold after rounding: 15 005 m is 15.0 km.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import constants as K
from ..functions.exprs import py_strip, python_float_text, python_round_km
from ..functions.literal import literal_table


def _ts(value) -> Column:
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def commute_rule(mode: Column | str, rules=None) -> tuple[Column, Column]:
    """CM-1: (travel mode, threshold km) for a commute mode after stripping;
    NULLs when no rule applies."""
    rules = rules or K.COMMUTE_RULES
    m = py_strip(F.col(mode) if isinstance(mode, str) else mode)
    travel = F.lit(None).cast("string")
    threshold = F.lit(None).cast("int")
    for name, tmode, km in reversed(rules):
        travel = F.when(m == F.lit(name), F.lit(tmode)).otherwise(travel)
        threshold = F.when(m == F.lit(name), F.lit(km)).otherwise(threshold)
    return travel, threshold


def validate_commutes(employees: DataFrame, distances: DataFrame, as_of=None,
                      company_address: str = "Head office", rules=None,
                      scope: str = "requested") -> DataFrame:
    """CM-2..CM-4: one validation row per employee.

    ``scope="requested"``: the employees present in ``distances`` (the ones
    submitted for validation). ``scope="all"``: every employee, as the
    reference's full run; a rule holder without a usable distance is ERROR.
    Routing answers that repeat an employee count as one.
    """
    how = "inner" if scope == "requested" else "left"
    # One answer for each employee: the shortest distance, else the least error
    # text (a partial aggregate on the key of the join below).
    d = distances.groupBy("employee_id").agg(
        F.min("distance_m").alias("_dist"),
        F.min(F.when(F.col("distance_m").isNull(), F.col("api_error"))).alias("_err"))
    travel, threshold = commute_rule("commute_mode", rules)
    # Stage 1: rule lookup and km once per row, as columns.
    staged = (employees.select("employee_id", "home_address", "commute_mode")
              .join(d, "employee_id", how)
              .select("*", travel.alias("_travel"), threshold.alias("_threshold"),
                      python_round_km("_dist", 2, integral=True).cast(S.KM).alias("_km")))
    # Stage 2: classification from those columns.
    has_rule = F.col("_travel").isNotNull()
    km, limit = F.col("_km"), F.col("_threshold").cast(S.KM)
    status = (F.when(~has_rule, F.lit(K.STATUS_NOT_APPLICABLE))
              .when(F.col("_dist").isNull(), F.lit(K.STATUS_ERROR))
              .when(km <= limit, F.lit(K.STATUS_VALID))
              .otherwise(F.lit(K.STATUS_ANOMALY)))
    measured = has_rule & F.col("_dist").isNotNull()
    reason = F.concat(F.lit(K.ANOMALY_PREFIX), python_float_text(km), F.lit(K.ANOMALY_MIDDLE),
                      F.col("_threshold").cast("string"), F.lit(K.ANOMALY_SUFFIX))
    return staged.select(
        "employee_id", "home_address",
        F.lit(company_address).alias("company_address"),
        "commute_mode",
        F.col("_travel").alias("google_travel_mode"),
        F.when(measured, F.col("_dist").cast("long")).alias("distance_m"),
        F.when(measured, km).alias("distance_km"),
        limit.alias("threshold_km"),
        status.alias("validation_status"),
        F.when(measured & (km > limit), reason).alias("anomaly_reason"),
        F.when(has_rule & F.col("_dist").isNull(),
               F.coalesce(F.col("_err"), F.lit(K.NO_DISTANCE_ERROR))).alias("api_error"),
        _ts(as_of).alias("checked_at"),
    )


def commute_anomalies(validation: DataFrame, employees: DataFrame) -> DataFrame:
    """CM-5 / JN-9 / FL-2: anomalies with the employee's name."""
    names = employees.select("employee_id", "first_name", "last_name")
    return (validation.where(F.col("validation_status") == K.STATUS_ANOMALY)
            .join(names, "employee_id")
            .select("employee_id", "first_name", "last_name", "home_address", "commute_mode",
                    "distance_km", "threshold_km", "anomaly_reason", "checked_at"))


def status_domain(spark: SparkSession) -> DataFrame:
    return literal_table(spark, [(s,) for s in K.COMMUTE_STATUSES], [("validation_status", "string")])


def commute_status_counts(validation: DataFrame) -> DataFrame:
    """AG-5: count per status, all four statuses present (0 when none)."""
    spark = validation.sparkSession
    counts = validation.groupBy("validation_status").agg(F.count(F.lit(1)).alias("_n"))
    # Bounded: one row per status the classification can produce (4 + NULL).
    return (status_domain(spark).join(F.broadcast(counts), "validation_status", "left")
            .select("validation_status",
                    F.coalesce(F.col("_n"), F.lit(0).cast("long")).alias("employee_count")))


def prune_orphans(child: DataFrame, parent: DataFrame, key: str = "employee_id") -> DataFrame:
    """JN-12: keep only child rows whose key still exists in the parent
    (the lake form of ``ON DELETE CASCADE``)."""
    return child.join(parent.select(key), key, "left_semi")
