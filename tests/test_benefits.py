import datetime as dt
from decimal import Decimal

from stridelake.operators import benefits as B

AS_OF = "2025-01-24 00:00:00"
EMP = "employee_id int, first_name string, last_name string, annual_gross_salary decimal(12,2), commute_mode string"
ACT = "activity_id long, employee_id int, start_at timestamp, distance_m decimal(18,2)"
CV = "employee_id int, validation_status string"
WALK, BIKE = "Marche/running", "Vélo/Trottinette/Autres"


def _acts(spark, per_emp):
    rows, i = [], 0
    for eid, n in per_emp.items():
        for _ in range(n):
            i += 1
            rows.append((i, eid, dt.datetime(2024, 6, 1), Decimal("1000.00")))
    return spark.createDataFrame(rows, ACT)


def test_eligibility_truth_table(spark):
    emp = spark.createDataFrame([
        (1, "A", "a", Decimal("40000.00"), WALK),      # 14 acts, VALID
        (2, "B", "b", Decimal("40000.00"), BIKE),      # 15 acts, no commute row -> NULL bonus
        (3, "C", "c", Decimal("40000.00"), "Transports en commun"),  # 16, no row -> FALSE
        (4, "D", "d", Decimal("40000.00"), WALK),      # ANOMALY -> FALSE
        (5, "E", "e", Decimal("40000.00"), None),      # null mode, ERROR -> FALSE
        (6, "F", "f", None, BIKE),                     # null salary, VALID -> amount NULL
    ], EMP)
    acts = _acts(spark, {1: 14, 2: 15, 3: 16})
    cv = spark.createDataFrame([(1, "VALID"), (4, "ANOMALY"), (5, "ERROR"), (6, "VALID")], CV)
    params = B.default_parameters(spark, "2025-01-01")
    out = {r.employee_id: r for r in B.benefit_eligibility(emp, acts, cv, params, AS_OF).collect()}
    assert out[1].activity_count_12m == 14 and out[1].wellness_eligible is False
    assert out[1].wellness_days == 0 and out[1].bonus_eligible is True
    assert out[1].bonus_amount == Decimal("2000.00")
    assert out[2].wellness_eligible is True and out[2].wellness_days == 5
    assert out[2].bonus_eligible is None and out[2].bonus_amount == 0
    assert out[3].wellness_eligible is True and out[3].bonus_eligible is False
    assert out[4].bonus_eligible is False
    assert out[5].bonus_eligible is False
    assert out[6].bonus_eligible is True and out[6].bonus_amount is None
    assert out[6].activity_count_12m == 0


def test_missing_parameter_gives_null_test_and_zero_days(spark):
    emp = spark.createDataFrame([(1, "A", "a", Decimal("1.00"), WALK)], EMP)
    acts = _acts(spark, {1: 20})
    params = B.default_parameters(spark, "2025-01-01").where("parameter_name <> 'min_annual_activities'")
    r = B.benefit_eligibility(emp, acts, spark.createDataFrame([], CV), params, AS_OF).collect()[0]
    assert r.wellness_eligible is None and r.wellness_days == 0


def test_two_open_versions_max_wins_and_as_of(spark):
    p = spark.createDataFrame([
        ("bonus_rate", Decimal("0.05"), dt.date(2024, 1, 1), None),
        ("bonus_rate", Decimal("0.07"), dt.date(2025, 1, 1), None),
        ("wellness_days", Decimal("3"), dt.date(2020, 1, 1), dt.date(2024, 1, 1)),
        ("wellness_days", Decimal("5"), dt.date(2024, 1, 1), None),
    ], "parameter_name string, parameter_value decimal(18,6), valid_from date, valid_to date")
    r = B.active_parameters(p).collect()[0]
    assert r.bonus_rate == Decimal("0.07") and r.wellness_days == 5 and r.min_activities is None
    h = B.active_parameters(p, as_of="2023-06-01").collect()[0]
    assert h.wellness_days == 3 and h.bonus_rate is None


def test_seed_parameters_only_when_no_open_version(spark):
    existing = spark.createDataFrame([
        ("bonus_rate", Decimal("0.10"), dt.date(2024, 1, 1), None),
        ("wellness_days", Decimal("4"), dt.date(2020, 1, 1), dt.date(2021, 1, 1)),
    ], "parameter_name string, parameter_value decimal(18,6), valid_from date, valid_to date")
    seeded = B.seed_parameters(existing, B.default_parameters(spark, "2025-01-24"))
    names = sorted(r.parameter_name for r in seeded.collect())
    assert names.count("bonus_rate") == 1 and names.count("wellness_days") == 2
    assert len(names) == 6
    again = B.seed_parameters(seeded, B.default_parameters(spark, "2025-01-25"))
    assert again.count() == 6


def test_window_bounds(spark):
    emp = spark.createDataFrame([(1, "A", "a", Decimal("1.00"), WALK)], EMP)
    acts = spark.createDataFrame([
        (1, 1, dt.datetime(2024, 1, 24, 0, 0, 0), Decimal("1.00")),          # on the bound: in
        (2, 1, dt.datetime(2024, 1, 23, 23, 59, 59, 999999), Decimal("2.00")),  # 1 us before: out
        (3, 1, dt.datetime(2026, 1, 1), None),                               # future: in
    ], ACT)
    r = B.employee_activity_12m(emp, acts, AS_OF).collect()[0]
    assert r.activity_count_12m == 2 and r.distance_m_12m == Decimal("1.00")
    # Feb 29 as_of: the bound clamps to Feb 28
    acts2 = spark.createDataFrame([(1, 1, dt.datetime(2023, 2, 28), None)], ACT)
    r2 = B.employee_activity_12m(emp, acts2, "2024-02-29 00:00:00").collect()[0]
    assert r2.activity_count_12m == 1


def test_as_of_defaults_to_now(spark):
    emp = spark.createDataFrame([(1, "A", "a", Decimal("1.00"), WALK)], EMP)
    acts = spark.createDataFrame([(1, 1, dt.datetime(2000, 1, 1), None), (2, 1, dt.datetime(2999, 1, 1), None)], ACT)
    r = B.employee_activity_12m(emp, acts).collect()[0]
    assert r.activity_count_12m == 1          # only the future row is within 12 months of now
    p = B.default_parameters(spark).collect()
    assert {x.valid_from for x in p} == {dt.datetime.now(dt.timezone.utc).date()}   # session time zone is UTC


def test_historical_recalculation_with_params_as_of(spark):
    emp = spark.createDataFrame([(1, "A", "a", Decimal("40000.00"), WALK)], EMP)
    cv = spark.createDataFrame([(1, "VALID")], CV)
    params = spark.createDataFrame([
        ("bonus_rate", Decimal("0.05"), dt.date(2020, 1, 1), dt.date(2024, 6, 1)),
        ("bonus_rate", Decimal("0.10"), dt.date(2024, 6, 1), None),
        ("wellness_days", Decimal("5"), dt.date(2020, 1, 1), None),
        ("min_annual_activities", Decimal("15"), dt.date(2020, 1, 1), None),
    ], "parameter_name string, parameter_value decimal(18,6), valid_from date, valid_to date")
    acts = _acts(spark, {1: 1})
    now = B.benefit_eligibility(emp, acts, cv, params, AS_OF).collect()[0]
    then = B.benefit_eligibility(emp, acts, cv, params, AS_OF, params_as_of="2024-03-01").collect()[0]
    assert now.bonus_amount == Decimal("4000.00") and then.bonus_amount == Decimal("2000.00")
