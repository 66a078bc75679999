"""Master data: CSV cleaning, effective sport, keyed upserts (SRC-7, SC-7..SC-11,
JN-10, SNK-8, SNK-9).

Cleaning is column expressions only (strip, comma decimals, blank -> NULL);
text that does not parse becomes NULL instead of failing the load, and is
counted by the profile. Upserts are set operations: the target rows whose key
is not in the change set, plus the change set (optionally keeping some
columns of the existing row, e.g. an ingestion stamp that is not refreshed on
conflict). Both touches of the target are semi/anti joins against the change
keys, whose small side Spark can broadcast: the target is scanned, not
shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.exprs import blank_to_null, default_sport, normalise_sport, text_to_decimal, text_to_int
from .cdc import latest_by_key

INT_COLUMNS = {"paid_leave_days"}
LONG_COLUMNS = {"employee_id"}
DATE_COLUMNS = {"birth_date", "hire_date"}
DECIMAL_COLUMNS = {"annual_gross_salary"}


def clean_employees(raw: DataFrame) -> DataFrame:
    """SC-9..SC-11 over text cells: typed employee rows (columns present in
    ``raw`` only, selected by name, never by position)."""
    out = []
    for f in S.EMPLOYEES.fields:
        if f.name not in raw.columns:
            continue
        c = F.col(f.name)
        if f.name in INT_COLUMNS:
            e = text_to_int(c)
        elif f.name in LONG_COLUMNS:
            e = text_to_int(c, "long")
        elif f.name in DECIMAL_COLUMNS:
            e = text_to_decimal(c, 12, 2)
        elif f.name in DATE_COLUMNS:
            e = blank_to_null(c).try_cast("date")
        else:
            e = blank_to_null(c)
        out.append(e.alias(f.name))
    return raw.select(*out)


def clean_sports(raw: DataFrame) -> DataFrame:
    return raw.select(text_to_int("employee_id", "long").alias("employee_id"),
                      blank_to_null("sport").alias("sport"))


def effective_sport(employees: DataFrame, sports: DataFrame) -> DataFrame:
    """JN-10 + SC-7 + SC-8: each employee's sport for activity generation:
    missing/empty -> default label, misspelling corrected."""
    return (employees.select("employee_id")
            .join(sports.select("employee_id", F.col("sport").alias("declared_sport")),
                  "employee_id", "left")
            .select("employee_id", "declared_sport",
                    normalise_sport(default_sport("declared_sport")).alias("effective_sport")))


def upsert_table(target: DataFrame, changes: DataFrame, key: str | list[str],
                 order: list[str] | None = None, preserve: tuple[str, ...] = ()) -> DataFrame:
    """SNK-8/SNK-9 (lake side of ``INSERT ... ON CONFLICT DO UPDATE``).

    ``order``: when the change set may hold several versions of a key, the
    newest by these columns wins (in-batch duplicates do not fail, unlike a
    database upsert). ``preserve``: columns kept from the existing row when
    the key already exists.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if order:
        changes = latest_by_key(changes, keys, order).select(*changes.columns)
    if preserve:
        # Reduce the (large) target to the changed keys first: a semi join
        # whose small side can be broadcast, so the target is not shuffled.
        kept = (target.join(changes.select(*keys), keys, "left_semi")
                .select(*keys, *[F.col(c).alias(f"_old_{c}") for c in preserve]))
        changes = (changes.join(kept, keys, "left")
                   .select(*[F.coalesce(F.col(f"_old_{c}"), F.col(c)).alias(c) if c in preserve
                             else F.col(c) for c in changes.columns]))
    untouched = target.join(changes.select(*keys), keys, "left_anti")
    return untouched.unionByName(changes.select(*target.columns))
