"""Benefits: parameters, 12-month activity, eligibility (SRC-11, SNK-11,
AG-1, AG-2, AG-4, JN-3..JN-6, JN-8).

Scale notes
-----------
* Activities are aggregated per employee *before* they meet the employee
  table (partial aggregation map-side, then one shuffle of one row per
  employee and map task). An employee holding a third of all activities costs
  one row per map task, never a hot partition.
* The employee table is joined to the per-employee counts and to the commute
  results on the same key, so one hash partitioning of employees serves both
  joins (or AQE broadcasts the small sides once their real size is known).
* Parameters are a one-row aggregate; they enter the plan as scalar
  subqueries (computed once, inlined as values), not as a join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import constants as K
from ..functions.literal import literal_table


def _ts(value) -> Column:
    """SC-16: an explicit ``as_of`` (text, datetime or Column), else now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def _date(value) -> Column:
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)[:10]).cast("date")


def default_parameters(spark: SparkSession, valid_from: str | _dt.date | None = None) -> DataFrame:
    """SRC-11: the default parameter set, valid from ``valid_from`` (default
    today), open."""
    df = literal_table(spark, K.DEFAULT_PARAMETERS,
                       [("parameter_name", "string"), ("parameter_value", "string")])
    return df.select(
        "parameter_name",
        F.col("parameter_value").cast(S.PARAM).alias("parameter_value"),
        _date(valid_from).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )


def seed_parameters(existing: DataFrame, defaults: DataFrame) -> DataFrame:
    """SNK-11: add a default only for names without an open version
    (``NOT EXISTS ... valid_to IS NULL`` as a left anti join)."""
    open_names = existing.where(F.col("valid_to").isNull()).select("parameter_name")
    new = defaults.join(open_names, "parameter_name", "left_anti")
    return existing.unionByName(new)


def active_parameters(params: DataFrame, as_of=None) -> DataFrame:
    """AG-2: pivot the open parameter versions into exactly one row.

    Default rule: "active" means ``valid_to IS NULL``; with two open versions
    MAX wins; a missing name gives NULL. With ``as_of`` the versions valid on
    that date (``valid_from <= d < coalesce(valid_to, +inf)``) are used
    instead, for historical recalculation.
    """
    if as_of is None:
        active = F.col("valid_to").isNull()
    else:
        d = _date(as_of)
        active = (F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (d < F.col("valid_to")))

    def pick(name: str) -> Column:
        return F.max(F.when(active & (F.col("parameter_name") == name), F.col("parameter_value")))

    return params.agg(
        pick("min_annual_activities").alias("min_activities"),
        pick("wellness_days").alias("wellness_days"),
        pick("bonus_rate").alias("bonus_rate"),
    )


def window_start(as_of) -> Column:
    """FL-3: lower bound of the rolling window, ``as_of - 12 months``."""
    return _ts(as_of) - F.expr("INTERVAL 12 MONTHS")


def activity_counts_12m(activities: DataFrame, as_of=None) -> DataFrame:
    """Per-employee count and distance sum over the rolling 12 months
    (inclusive lower bound, no upper bound: future rows count)."""
    bound = window_start(as_of)
    cond = F.col("start_at") >= bound
    if "activity_date" in activities.columns:
        # Implied by the bound (the date of a UTC timestamp is monotonic):
        # lets a table partitioned by activity_date skip old partitions.
        cond = cond & (F.col("activity_date") >= F.to_date(bound))
    return (activities
            .where(cond)
            .groupBy("employee_id")
            .agg(F.count("activity_id").alias("_n"), F.sum("distance_m").alias("_m")))


def employee_activity_12m(employees: DataFrame, activities: DataFrame, as_of=None) -> DataFrame:
    """AG-1 / JN-3: every employee with activity count and distance (0 when
    none) over the 12 months before ``as_of``."""
    return activity_totals_view(employees, activity_counts_12m(activities, as_of))


def activity_totals_view(employees: DataFrame, counts: DataFrame) -> DataFrame:
    """Every employee with ``counts`` (employee_id, _n, _m); distances keep
    their six decimals."""
    return (employees.select("employee_id", "first_name", "last_name")
            .join(counts, "employee_id", "left")
            .select(
                "employee_id", "first_name", "last_name",
                F.coalesce(F.col("_n"), F.lit(0).cast("long")).alias("activity_count_12m"),
                F.coalesce(F.col("_m"), F.lit(0)).cast("decimal(38,6)").alias("distance_m_12m"),
            ))


def benefit_eligibility(employees: DataFrame, activities: DataFrame, commute: DataFrame,
                        params: DataFrame, as_of=None, params_as_of=None) -> DataFrame:
    """AG-4 (flagship): wellness days and commute bonus per employee.

    * ``wellness_eligible = count >= min_activities`` (NULL if the parameter
      is missing); ``wellness_days`` is the parameter when that test is TRUE,
      else 0.
    * ``bonus_eligible = mode IN (walk, bike) AND status = 'VALID'``, with SQL
      three-valued logic (physical mode without a commute row -> NULL).
    * ``bonus_amount = ROUND(salary * rate, 2)`` when eligible, else 0.
    """
    p = active_parameters(params, params_as_of)
    min_activities = p.select("min_activities").scalar()
    wellness = p.select("wellness_days").scalar()
    rate = p.select("bonus_rate").scalar()

    counts = activity_counts_12m(activities, as_of)
    status = commute.select("employee_id", "validation_status")
    base = (employees.select("employee_id", "first_name", "last_name",
                             "annual_gross_salary", "commute_mode")
            .join(counts, "employee_id", "left")
            .join(status, "employee_id", "left"))

    n = F.coalesce(F.col("_n"), F.lit(0).cast("long"))
    return base.select(
        "employee_id", "first_name", "last_name", "annual_gross_salary", "commute_mode",
        n.alias("activity_count_12m"),
        *wellness_columns(n, min_activities, wellness), *bonus_columns(rate),
    )


def wellness_columns(n: Column, min_activities: Column, days: Column) -> list[Column]:
    ok = n >= min_activities
    return [ok.alias("wellness_eligible"),
            F.when(ok, days).otherwise(F.lit(0)).cast(S.PARAM).alias("wellness_days")]


def bonus_columns(rate: Column) -> list[Column]:
    ok = (F.col("commute_mode").isin(*K.PHYSICAL_MODES)
          & (F.col("validation_status") == F.lit(K.STATUS_VALID)))
    return [ok.alias("bonus_eligible"),
            F.when(ok, F.round(F.col("annual_gross_salary") * rate, 2))
            .otherwise(F.lit(0)).cast("decimal(18,2)").alias("bonus_amount")]
