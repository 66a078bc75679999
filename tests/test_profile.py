"""Golden profile on invented rows with hand-computed answers."""

import datetime as dt
from decimal import Decimal

from stridelake.operators import profile as P

EMP = ("employee_id int, last_name string, first_name string, birth_date date, business_unit string, "
       "hire_date date, annual_gross_salary decimal(12,2), contract_type string, paid_leave_days int, "
       "home_address string, commute_mode string")


def _data(spark):
    emp = spark.createDataFrame([
        (1, "A", "a", dt.date(1990, 1, 1), "R&D", dt.date(2020, 1, 1), Decimal("30000.00"), "CDI", 25, "x", "Marche/running"),
        (2, "B", "b", dt.date(2030, 1, 1), "R&D", dt.date(2026, 1, 1), Decimal("40000.01"), "CDI", 25, " ", "Marche/running"),
        (2, "B", "b", dt.date(1980, 1, 1), "Finance", dt.date(2010, 1, 1), Decimal("-10.00"), "CDD", 25, "y", None),
        (4, "D", "d", dt.date(1985, 1, 1), "Finance", dt.date(2015, 1, 1), None, "CDI", 25, "z", "Transports en commun"),
    ], EMP)
    sports = spark.createDataFrame([(1, "Judo"), (2, ""), (9, None), (9, "Runing")], "employee_id int, sport string")
    return emp, sports


def test_profile_summary_golden(spark):
    emp, sports = _data(spark)
    got = {r.indicator: r.value for r in P.profile_summary(emp, sports, "2025-01-24").collect()}
    assert got == {
        "employees_rows": 4, "employees_unique_ids": 3, "employees_duplicate_ids": 1,
        "sports_rows": 4, "sports_unique_ids": 3, "sports_without_rh": 2, "rh_without_sports_row": 1,
        "sport_declared": 2, "sport_missing": 2,
        "salary_min": Decimal("-10.00"), "salary_max": Decimal("40000.01"),
        "salary_avg": Decimal("23330.00"),            # (30000 + 40000.01 - 10) / 3 = 23330.003 -> 23330.00
        "missing_addresses": 1, "missing_commute": 1, "future_birth_dates": 1, "future_hire_dates": 1,
        "negative_salary": 1,
    }


def test_profile_distribution_and_anomalies(spark):
    emp, sports = _data(spark)
    dist = {(r.dimension, r.value): (r.n, r.percent) for r in P.profile_distribution(emp, sports).collect()}
    assert dist[("commute_modes", "Marche/running")] == (2, Decimal("50.0"))
    assert dist[("commute_modes", "(vide)")] == (1, Decimal("25.0"))
    assert dist[("sports", "(vide)")] == (2, Decimal("50.0"))
    assert dist[("contracts", "CDI")] == (3, Decimal("75.0"))
    an = {r.control: (r.severity, r.anomaly_count) for r in
          P.profile_anomalies(P.profile_summary(emp, sports, "2025-01-24")).collect()}
    assert an["Salariés sans sport déclaré"] == ("Information", 2)
    assert an["Identifiants salariés en double"] == ("Critique", 1)
    assert len(an) == 9
