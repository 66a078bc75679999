"""Silver enrichment and published projections (JN-1, JN-2, PR-5..PR-9,
SC-1, SC-3, SC-4, SC-6, SC-20).

Bronze rows are joined to the employee and sport reference tables (left
joins: an activity of an unknown employee is kept with NULL attributes) and
gain parsed timestamps, the activity date, the duration in minutes and the
distance in km.

Join strategy: the reference tables grow with the number of employees, not
with the activity volume. No broadcast hint is forced on them; Spark
broadcasts a side only when its estimated (or, under AQE, measured) size is
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with
AQE splitting a hot employee key of the activity side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.exprs import duration_minutes_1dp, metres_to_km_2dp, parse_iso_ts
from .keys import one_per_key, rows_for_keys


def _stamp(value) -> Column:
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def employee_reference(employees: DataFrame) -> DataFrame:
    """Typed projection of the employee reference used by Silver (PR-9)."""
    return employees.select(
        F.col("employee_id").cast("long").alias("ref_employee_id"),
        "first_name", "last_name", "business_unit", "contract_type",
        F.col("annual_gross_salary").cast(S.SALARY).alias("annual_gross_salary"),
    )


def sport_reference(sports: DataFrame) -> DataFrame:
    return sports.select(F.col("employee_id").cast("long").alias("sport_employee_id"),
                         F.col("sport").alias("declared_sport"))


def reference_attributes(employees: DataFrame, sports: DataFrame, dedupe: bool = True) -> DataFrame:
    """Employee and sport references combined into one employee-keyed table
    (full outer join: a key present in only one of them keeps the other's
    columns NULL).

    Reference files carry no uniqueness guarantee; with ``dedupe`` (default)
    each key keeps one deterministic row so an activity is never duplicated
    by a repeated reference line (duplicates are reported by the profile).
    ``dedupe=False`` multiplies rows exactly as two successive left joins.
    """
    emp = employee_reference(employees)
    spo = sport_reference(sports)
    if dedupe:
        emp, spo = one_per_key(emp, "ref_employee_id"), one_per_key(spo, "sport_employee_id")
    joined = emp.join(spo, F.col("ref_employee_id") == F.col("sport_employee_id"), "full_outer")
    return joined.select(
        F.coalesce(F.col("ref_employee_id"), F.col("sport_employee_id")).alias("_ref_key"),
        "first_name", "last_name", "business_unit", "contract_type", "annual_gross_salary",
        "declared_sport")


def enrich(bronze: DataFrame, employees: DataFrame, sports: DataFrame,
           ingested_at=None, dedupe_references: bool = True,
           reduce_references: bool = False) -> DataFrame:
    """Silver log rows: every Bronze column, plus ``start_ts``, ``end_ts``,
    employee attributes, ``declared_sport`` (not normalised), ``activity_date``,
    ``duration_minutes``, ``distance_km``, ``silver_ingested_at``.

    The two references are combined first (both are employee-sized), so the
    activity rows meet them in a single join: one shuffle of the large side
    at most, and AQE can split a hot employee's partition (it will not split
    the first of two chained joins that share a partitioning).

    ``reduce_references`` (streaming micro-batches): the references are first
    cut to the employees present in the batch, so a large reference table is
    filtered, not shuffled, on every trigger.
    """
    key = F.col("employee_id").cast("long")
    if reduce_references:
        # Micro-batch mode: only the employees of this batch are looked up.
        batch_keys = bronze.select(key.alias("_k"))
        employees = rows_for_keys(employees, "employee_id", batch_keys, "_k")
        sports = rows_for_keys(sports, "employee_id", batch_keys, "_k")
    refs = reference_attributes(employees, sports, dedupe_references)
    start_ts, end_ts = parse_iso_ts("start_at"), parse_iso_ts("end_at")
    return (bronze
            .join(refs, key == F.col("_ref_key"), "left")
            .select(*bronze.columns,
                    start_ts.alias("start_ts"), end_ts.alias("end_ts"),
                    "first_name", "last_name", "business_unit", "contract_type",
                    "annual_gross_salary", "declared_sport",
                    F.to_date(start_ts).alias("activity_date"),
                    duration_minutes_1dp(start_ts, end_ts).alias("duration_minutes"),
                    metres_to_km_2dp("distance_m").alias("distance_km"),
                    _stamp(ingested_at).alias("silver_ingested_at")))


def serving_projection(silver: DataFrame) -> DataFrame:
    """PR-6: the 15 published columns with their serving types. Salary stays
    out of every published projection. The employee id stays 64-bit (a
    32-bit serving column would overflow at the target scale)."""
    return silver.select(
        F.col("activity_id").cast("long").alias("activity_id"),
        F.col("employee_id").cast("long").alias("employee_id"),
        *S.SERVING_COLUMNS[2:],
    )


def bi_projection(silver: DataFrame) -> DataFrame:
    """PR-7: the 14 BI columns (serving minus the ingestion stamp)."""
    return silver.select(*S.BI_COLUMNS)


def as_activities(silver: DataFrame) -> DataFrame:
    """Silver rows in the domain ``activities`` shape (typed timestamps,
    decimal distance), keeping ``activity_date`` for partition pruning, so
    benefits and data-quality jobs run directly on the lake."""
    return silver.select(
        F.col("activity_id").cast("long").alias("activity_id"),
        F.col("employee_id").cast("long").alias("employee_id"),
        F.col("start_ts").alias("start_at"),
        F.col("end_ts").alias("end_at"),
        "sport_type",
        F.col("distance_m").cast("decimal(24,6)").cast(S.DISTANCE).alias("distance_m"),
        "comment", "source",
        parse_iso_ts("created_at").alias("created_at"),
        "activity_date",
    )


def drop_sensitive(df: DataFrame) -> DataFrame:
    """Remove salary and address columns for non-HR consumers."""
    return df.drop("annual_gross_salary", "home_address")
