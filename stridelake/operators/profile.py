"""Profiling of the master data (AG-7, AG-8, AG-9).

* ``profile_summary``: the profile indicators as ``(indicator, value)`` rows.
  Each table is scanned once; per-id sums of both meet in a full outer join,
  which also gives duplicates and the two referential gaps.
* ``profile_distribution``: value counts with their share per dimension.
  The per-dimension totals (one row per dimension, a fixed handful) are
  joined back on the dimension name; no window over the whole result.
* ``profile_anomalies``: nonzero controls with a severity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import blank_to_null, percent_1dp
from ..functions.literal import literal_table

VALUE = "decimal(18,2)"



def _d(value) -> Column:
    """``as_of`` as a date; today when not given (SC-16)."""
    if value is None:
        return F.current_date()
    return value.cast("date") if isinstance(value, Column) else F.lit(str(value)[:10]).cast("date")


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def _long(df: DataFrame, names: list[str]) -> DataFrame:
    """One-row wide aggregate -> (indicator, value) rows."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("indicator"), F.col(n).cast(VALUE).alias("value")) for n in names
    ])).alias("_r")).select("_r.*")


def avg_2dp(cents_sum: Column, n: Column) -> Column:
    """Average rounded half away from zero to 2 decimals, from an exact sum
    of cents and a count (no binary or truncated decimal division)."""
    num = F.abs(cents_sum) * 2 + n
    q = ((num - F.pmod(num, n * 2)) / (n * 2)).cast("long")
    signed = F.when(cents_sum < 0, -q).otherwise(q)
    return F.when(n > 0, signed.cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)"))


def profile_summary(employees: DataFrame, sports: DataFrame, as_of=None) -> DataFrame:
    """AG-7. Both tables are first summed for each employee id (partial
    aggregates, so a repeated id costs one row for each task) and meet in one
    full outer join on the id; one global row sums that up."""
    today = _d(as_of)
    sal = F.col("annual_gross_salary")
    emp = employees.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("_e"),
        F.min(sal).alias("_min"), F.max(sal).alias("_max"),
        F.sum((sal * 100).cast("long")).alias("_cents"), F.count(sal).alias("_n"),
        _count_if(blank_to_null("home_address").isNull()).alias("_address"),
        _count_if(blank_to_null("commute_mode").isNull()).alias("_mode"),
        _count_if(F.col("birth_date") > today).alias("_birth"),
        _count_if(F.col("hire_date") > today).alias("_hire"),
        _count_if(sal < 0).alias("_negative")).withColumn("_has_e", F.lit(True))
    spo = sports.groupBy(F.col("employee_id").alias("_sid")).agg(
        F.count(F.lit(1)).alias("_s"),
        _count_if(blank_to_null("sport").isNotNull()).alias("_declared"),
        _count_if(blank_to_null("sport").isNull()).alias("_missing")).withColumn("_has_s", F.lit(True))
    both = emp.join(spo, F.col("employee_id") == F.col("_sid"), "full_outer")

    def rows(c: str, where: Column | None = None) -> Column:
        value = F.col(c) if where is None else F.when(where, F.col(c))
        return F.coalesce(F.sum(value), F.lit(0).cast("long"))

    one = both.agg(
        rows("_e").alias("employees_rows"), F.count("employee_id").alias("employees_unique_ids"),
        F.min("_min").alias("salary_min"), F.max("_max").alias("salary_max"),
        F.sum("_cents").alias("_cents"), rows("_n").alias("_n"),
        F.sum("_address").alias("missing_addresses"), F.sum("_mode").alias("missing_commute"),
        F.sum("_birth").alias("future_birth_dates"), F.sum("_hire").alias("future_hire_dates"),
        F.sum("_negative").alias("negative_salary"),
        rows("_s").alias("sports_rows"), F.count("_sid").alias("sports_unique_ids"),
        F.sum("_declared").alias("sport_declared"), F.sum("_missing").alias("sport_missing"),
        rows("_s", F.col("_has_e").isNull()).alias("sports_without_rh"),
        rows("_e", F.col("_has_s").isNull()).alias("rh_without_sports_row"))
    one = one.select("*", (F.col("employees_rows") - F.col("employees_unique_ids")).alias("employees_duplicate_ids"),
                     avg_2dp(F.col("_cents"), F.col("_n")).alias("salary_avg"))
    return _long(one, ["employees_rows", "employees_unique_ids", "employees_duplicate_ids",
                       "salary_min", "salary_max", "salary_avg", "missing_addresses",
                       "missing_commute", "future_birth_dates", "future_hire_dates",
                       "negative_salary", "sports_rows", "sports_unique_ids", "sport_declared",
                       "sport_missing", "sports_without_rh", "rh_without_sports_row"])


DIMENSIONS = [("commute_modes", "commute_mode"), ("business_units", "business_unit"),
              ("contracts", "contract_type")]


def profile_distribution(employees: DataFrame, sports: DataFrame) -> DataFrame:
    """AG-8: ``(dimension, value, n, percent)``; empty values are labelled
    ``(vide)``; percent = round(100 * n / total of the dimension, 1)."""
    def label(c: str) -> Column:
        return F.coalesce(blank_to_null(c), F.lit(K.EMPTY_LABEL))

    pairs = employees.select(F.explode(F.array(*[
        F.struct(F.lit(dim).alias("dimension"), label(c).alias("value")) for dim, c in DIMENSIONS
    ])).alias("_p")).select("_p.*")
    pairs = pairs.unionByName(sports.select(F.lit("sports").alias("dimension"),
                                            label("sport").alias("value")))
    counts = pairs.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("dimension").agg(F.sum("n").alias("_total"))
    return (counts.join(F.broadcast(totals), "dimension")   # one row per dimension: bounded
            .select("dimension", "value", "n", percent_1dp("n", "_total").alias("percent")))


def profile_anomalies(summary: DataFrame) -> DataFrame:
    """AG-9: ``(severity, control, anomaly_count)`` for every nonzero control."""
    spark = summary.sparkSession
    controls = literal_table(spark, K.PROFILE_CONTROLS, [("indicator", "string"), ("severity", "string"),
                                               ("control", "string")])
    return (summary.join(F.broadcast(controls), "indicator")   # fixed 9-row table
            .where(F.col("value") > 0)
            .select("severity", "control", F.col("value").cast("long").alias("anomaly_count")))
