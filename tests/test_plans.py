"""Physical-plan properties that matter at scale."""

import pytest

import __spark_entry__ as E
from stridelake.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_filter_reaches_scan(spark):
    p = _plan(E.queries()["employee_activity_12m"](spark, SF))
    assert "GreaterThanOrEqual(ts," in p          # pushed to the parquet reader
    assert "partial_count" in p                   # aggregated before the join


def scans(plan, table):
    return plan.count(f"{table}.parquet]")


def test_dq_reads_activities_twice_and_shuffles_keys_only(spark):
    p = _plan(E.queries()["dq_results"](spark, SF))
    assert "Generate inline" in p
    # distinct keys are anti-joined, the unknown ones flag the rows
    assert p.count("LeftAnti") == 1 and scans(p, "events") == 2


@pytest.mark.parametrize("name", ["cdc_decode", "cdc_malformed", "silver_enriched", "serving_projection",
                                  "bi_projection", "silver_current", "live_notifications"])
def test_change_log_is_one_scan(spark, name):
    assert scans(_plan(E.queries()[name](spark, SF)), "events") == 1


def test_profile_scans_each_table_once(spark):
    p = _plan(E.queries()["profile_summary"](spark, SF))
    assert scans(p, "customer") == 2 and p.count("Exchange ") <= 3     # both tables derive from customer


def test_stream_cuts_employees_before_it_dedupes_them(spark):
    from stridelake.operators import notify as N
    from stridelake.sources import adapter as A
    events = spark.createDataFrame([], "activity_id long, employee_id long, start_at string, end_at string, "
                                   "sport_type string, distance_m double, comment string, source string, "
                                   "__op string, kafka_offset long")
    plan = N.notifications(events, A.employees(spark, SF), reduce_references=True) \
        ._jdf.queryExecution().analyzed().toString()
    lines = plan.splitlines()
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    dedupe = next(i for i, x in enumerate(lines) if "max(struct" in x)
    assert dedupe < semi                # the aggregate is above the semi join


def test_parameters_are_scalar_subqueries_not_joins(spark):
    p = _plan(E.queries()["benefit_eligibility"](spark, SF))
    assert "Subquery" in p and "Cartesian" not in p and "BroadcastNestedLoopJoin" not in p


def test_current_state_uses_partial_aggregation(spark):
    p = _plan(E.queries()["silver_current"](spark, SF))
    assert "partial_max_by" in p and "Window" not in p


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(E.queries()["recent_activities"](spark, SF))


def test_no_python_udf_anywhere(spark):
    for name, fn in REGISTRY.items():
        p = _plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_reference_joins_broadcast_only_behind_size_check(spark):
    q = E.queries()["silver_enriched"]
    small = _plan(q(spark, SF))
    assert "BroadcastHashJoin" in small and "LeftOuter" in small
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, "-1")           # the reference side is "too big"
        big = q(spark, SF)
        big._jdf.queryExecution().executedPlan()     # planning only
        p = big._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)


def test_change_messages_are_parsed_once(spark):
    # a filter on decoded fields (source = 'live') must not drag the JSON
    # parse into pushed-down predicates
    for name in ("live_notifications", "silver_enriched", "cdc_decode"):
        df = E.queries()[name](spark, SF)
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1, name


def test_hot_employee_partition_is_split_in_silver_join(spark):
    """One employee owns a third of the activities and the references are
    too big to broadcast: AQE must split the hot partition of the single
    activity-side join."""
    from stridelake.operators import silver as SV
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        bronze = spark.range(300000).selectExpr(
            "id as activity_id", "case when id % 3 = 0 then 7 else id % 5000 end as employee_id",
            "'2024-01-01T10:00:00Z' as start_at", "'2024-01-01T11:00:00Z' as end_at",
            "cast(1000.0 as double) as distance_m")
        emp = spark.range(5000).selectExpr(
            "cast(id as int) as employee_id", "'f' as first_name", "'l' as last_name", "'bu' as business_unit",
            "'CDI' as contract_type", "cast(30000 as decimal(12,2)) as annual_gross_salary")
        sp = spark.range(5000).selectExpr("cast(id as int) as employee_id", "'Judo' as sport")
        df = SV.enrich(bronze, emp, sp).select("activity_id", "first_name", "declared_sport")
        rows = df.collect()
        assert len(rows) == 300000 and all(r.first_name == "f" and r.declared_sport == "Judo" for r in rows)
        assert "SortMergeJoin(skew=true)" in _plan(df)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_bucketed_tables_aggregate_and_join_without_shuffle(spark, tmp_path):
    from stridelake.operators import benefits as B
    from stridelake.sinks.lake import save_bucketed
    from stridelake.sources import adapter as A
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        save_bucketed(A.activities(spark, SF), "bk_activities", "employee_id", 8, path=str(tmp_path / "a"))
        save_bucketed(A.employees(spark, SF), "bk_employees", "employee_id", 8, path=str(tmp_path / "e"))
        acts, emps = spark.table("bk_activities"), spark.table("bk_employees")
        df = B.employee_activity_12m(emps, acts, "2025-01-24 00:00:00")
        plan = _plan(df)
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert df.count() == emps.count()
        plain = B.employee_activity_12m(A.employees(spark, SF), A.activities(spark, SF), "2025-01-24 00:00:00")
        got = {r.employee_id: r.activity_count_12m for r in df.collect()}
        assert got == {r.employee_id: r.activity_count_12m for r in plain.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
        spark.sql("DROP TABLE IF EXISTS bk_activities")
        spark.sql("DROP TABLE IF EXISTS bk_employees")
