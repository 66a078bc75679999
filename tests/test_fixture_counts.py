"""Golden counts of FIXTURES.md section 4 (computed there independently in
DuckDB) reproduced by the Spark queries at sf0.001."""

import os

import pytest

import __spark_entry__ as E
from stridelake.sources import adapter as A

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_fixture_counts(spark):
    q = E.queries()
    dq = {r.rule_name[:4]: r.anomaly_count for r in q["dq_summary"](spark, SF).collect()}
    assert dq == {"DQ01": 17, "DQ02": 64, "DQ03": 65, "DQ04": 77, "DQ05": 63,
                  "DQ06": 356, "DQ07": 65, "DQ08": 136}
    v = q["employee_activity_12m"](spark, SF)
    assert (v.where("activity_count_12m >= 15").count(), v.where("activity_count_12m = 0").count(),
            v.count()) == (3, 135, 150)
    assert A.activities(spark, SF).where("source = 'live'").count() == 200
    cs = {r.validation_status: r.employee_count for r in q["commute_status_counts"](spark, SF).collect()}
    assert cs == {"VALID": 33, "ANOMALY": 29, "ERROR": 14, "NOT_APPLICABLE": 74}
    ops = {r["__op"]: r["count"] for r in A.cdc_log(spark, SF).groupBy("__op").count().collect()}
    assert ops == {"c": 972, "r": 28, "u": 112, "d": 23}


def test_every_case_occurs(spark):
    """No row is dropped to make a case: one row for each customer, and every
    rule, reject reason and arm of the upsert is non-empty."""
    q = E.queries()
    customers = spark.read.parquet(f"{SF}/customer.parquet").count()
    for name in ("benefit_eligibility", "commute_validation", "employee_activity_12m", "effective_sport"):
        assert q[name](spark, SF).count() == customers
    assert q["benefit_eligibility"](spark, SF).where("bonus_eligible IS NULL").count() == 8
    reasons = {r.reject_reason for r in q["intake_rejected"](spark, SF).select("reject_reason").distinct().collect()}
    assert len(reasons) == 5
    target = A.master_target(spark, SF)
    merged = q["master_upsert"](spark, SF)
    key, old = ["employee_id"], target.select("employee_id")
    assert merged.join(target, merged.columns).count() > 0                                   # untouched
    assert merged.join(old, key, "left_anti").count() > 0                                    # inserted
    assert merged.join(old, key).where("last_name like 'Name%' and ingested_at < '2025-01-24'").count() > 0
    changes = A.master_changes(spark, SF)
    assert changes.groupBy("employee_id").count().where("count > 1").count() > 0             # repeated
    assert merged.count() == merged.select("employee_id").distinct().count()
    profile = {r.indicator: r.value for r in q["profile_summary"](spark, SF).collect()}
    assert profile["sports_without_rh"] == profile["rh_without_sports_row"] == 15
