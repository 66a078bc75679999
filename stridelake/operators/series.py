"""Eligibility for a series of dates in one pass (AG-2, AG-4, SNK-11).

An activity counts at every date of the series from the first one until it is
twelve months old. One scan counts an employee's activities for all dates
(partial sums on the map side: one row for each employee and task, whatever the
number of activities); employees meet their counts as one row each, and that
row is copied to the dates last, when nothing is left to sort or to keep.
Parameters are joined to the dates they are valid on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .benefits import bonus_columns, wellness_columns, window_start


def parameters_by_date(params: DataFrame, dates: list[str]) -> DataFrame:
    """``(place, min_activities, wellness_days, bonus_rate)``: the versions
    valid at each date (MAX of several), as ``active_parameters`` with a date.
    An interval join: a version is copied to the places of the series it spans."""
    days = F.array(*[F.lit(d).cast("date") for d in dates])
    places = F.filter(F.sequence(F.lit(0), F.lit(len(dates) - 1)), lambda i: (
        F.element_at(days, i + 1) >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.element_at(days, i + 1) < F.col("valid_to"))))
    spread = params.select("parameter_name", "parameter_value", F.explode(places).alias("place"))

    def pick(name: str) -> Column:
        return F.max(F.when(F.col("parameter_name") == name, F.col("parameter_value")))

    return spread.groupBy("place").agg(pick("min_annual_activities").alias("min_activities"),
                                       pick("wellness_days").alias("wellness_days"), pick("bonus_rate").alias("bonus_rate"))


def activity_counts_series(employees: DataFrame, activities: DataFrame, dates: list[str]) -> DataFrame:
    """``(employee columns..., place, activity_count_12m)``, one row for each
    employee and date; ``dates`` ascending. As in the single run, activities
    after a date count too (there is no upper bound)."""
    bounds = [window_start(d) for d in dates]
    totals = (activities.where(F.col("activity_id").isNotNull() & (F.col("start_at") >= bounds[0]))
              .groupBy("employee_id").agg(F.array(*[F.count_if(F.col("start_at") >= b) for b in bounds]).alias("_counts")))
    columns = [c for c in employees.columns if c != "employee_id"]
    person = F.struct(*columns)
    empty = F.lit(None).cast(employees.select(person.alias("p")).schema["p"].dataType)
    every = employees.select("employee_id", F.lit(None).cast("array<bigint>").alias("_counts"), person.alias("_person"))
    # Dealt by employee before the maxima: they sort their rows, and would sort
    # those of a whole scan task first. Employees without a key are one group.
    met = (totals.withColumn("_person", empty).unionByName(every).repartition("employee_id")
           .groupBy("employee_id").agg(F.max("_counts").alias("_counts"), F.max("_person").alias("_person"))
           .where(F.col("_person").isNotNull()))
    none = F.array(*[F.lit(0).cast("long") for _ in dates])
    return met.select("employee_id", *[F.col(f"_person.{c}").alias(c) for c in columns],
                      F.posexplode(F.coalesce("_counts", none)).alias("place", "activity_count_12m"))


def eligibility_series(employees: DataFrame, activities: DataFrame, commute: DataFrame, params: DataFrame,
                       dates: list[str]) -> DataFrame:
    """``benefit_eligibility`` (with ``params_as_of`` the same date) for every
    date of the series, as column ``as_of``."""
    dates = sorted({str(d)[:10] for d in dates})
    days = F.array(*[F.lit(d).cast("date") for d in dates])
    base = employees.select("employee_id", "first_name", "last_name", "annual_gross_salary", "commute_mode")
    base = base.join(commute.select("employee_id", "validation_status"), "employee_id", "left")
    counted = activity_counts_series(base, activities, dates)
    # Bounded: one row for each date.
    rows = counted.join(F.broadcast(parameters_by_date(params, dates)), "place", "left")
    n = F.col("activity_count_12m")
    return rows.select(
        "employee_id", F.element_at(days, F.col("place") + 1).alias("as_of"), "first_name", "last_name", "annual_gross_salary",
        "commute_mode", n, *wellness_columns(n, F.col("min_activities"), F.col("wellness_days")),
        *bonus_columns(F.col("bonus_rate")))
