"""Operators produce the declared schemas (names and types, in order)."""

from stridelake import schemas as S
from stridelake.operators import benefits as B
from stridelake.operators import commute as C
from stridelake.operators import quality as Q
from stridelake.sources import adapter as A

SF = "/root/testdata/sf0.001"


def _shape(st):
    return [(f.name, f.dataType) for f in st.fields]


def test_declared_schemas(spark):
    assert _shape(A.employees(spark, SF).schema) == _shape(S.EMPLOYEES)
    assert _shape(A.employee_sports(spark, SF).schema) == _shape(S.EMPLOYEE_SPORTS)
    assert _shape(A.activities(spark, SF).schema) == _shape(S.ACTIVITIES)
    assert _shape(A.commute_distances(spark, SF).schema) == _shape(S.COMMUTE_DISTANCES)
    assert _shape(B.default_parameters(spark, "2025-01-24").schema) == _shape(S.BENEFIT_PARAMETERS)
    cv = C.validate_commutes(A.employees(spark, SF), A.commute_distances(spark, SF), "2025-01-24")
    assert _shape(cv.schema) == _shape(S.COMMUTE_VALIDATION)
    dq = Q.dq_results(A.activities(spark, SF), A.employees(spark, SF), "2024-01-29")
    assert _shape(dq.schema) == _shape(S.DQ_RESULTS)


def test_bronze_schema_matches_decoder(spark):
    from stridelake.operators.cdc import decode_cdc
    raw = spark.createDataFrame([], "value string, topic string, partition int, offset long, timestamp timestamp")
    assert _shape(decode_cdc(raw).schema) == _shape(S.BRONZE)


def test_employee_ids_beyond_32_bits(spark):
    """At the target scale employee ids exceed 2**31; nothing may overflow."""
    import json
    from decimal import Decimal

    from stridelake.operators import cdc, notify, silver
    big = 5_000_000_123
    emp = spark.createDataFrame([(big, "Ana", "Lopez", "R&D", "CDI", Decimal("1000.00"), "Marche/running")],
                                "employee_id long, first_name string, last_name string, business_unit string, "
                                "contract_type string, annual_gross_salary decimal(12,2), commute_mode string")
    sp = spark.createDataFrame([(big, "Judo")], "employee_id long, sport string")
    msg = json.dumps({"payload": {"activity_id": 1, "employee_id": big, "start_at": "2024-06-01T10:00:00Z",
                                  "end_at": "2024-06-01T11:00:00Z", "sport_type": "Judo", "source": "live",
                                  "__op": "c", "__source_ts_ms": 1}})
    raw = spark.createDataFrame([(msg, "t", 0, 1, None)],
                                "value string, topic string, partition int, offset long, timestamp timestamp")
    bronze = cdc.decode_cdc(raw)
    s = silver.enrich(cdc.only_valid(bronze), emp, sp)
    row = silver.serving_projection(s).collect()[0]
    assert row.employee_id == big and row.first_name == "Ana" and row.declared_sport == "Judo"
    acts = silver.as_activities(s)
    assert Q.dq_results(acts, emp, "2025-01-24").count() == 0
    ben = B.benefit_eligibility(emp, acts, spark.createDataFrame([(big, "VALID")], "employee_id long, "
                                "validation_status string"), B.default_parameters(spark, "2025-01-01"),
                                "2025-01-24").collect()[0]
    assert ben.employee_id == big and ben.activity_count_12m == 1 and ben.bonus_amount == Decimal("50.00")
    note = notify.notifications(bronze, emp).collect()[0]
    assert note.message.startswith("🏃 Bravo Ana Lopez")
