"""Declared schemas of the domain tables (never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Identifiers are 64-bit everywhere: at the target scale employee ids exceed
# the 32-bit range a source database may use.
SALARY = DecimalType(12, 2)
DISTANCE = DecimalType(18, 6)
KM = DecimalType(10, 2)
PARAM = DecimalType(18, 6)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


EMPLOYEES = _s(
    ("employee_id", LongType()),
    ("last_name", StringType()),
    ("first_name", StringType()),
    ("birth_date", DateType()),
    ("business_unit", StringType()),
    ("hire_date", DateType()),
    ("annual_gross_salary", SALARY),
    ("contract_type", StringType()),
    ("paid_leave_days", IntegerType()),
    ("home_address", StringType()),
    ("commute_mode", StringType()),
)

EMPLOYEE_SPORTS = _s(
    ("employee_id", LongType()),
    ("sport", StringType()),
)

ACTIVITIES = _s(
    ("activity_id", LongType()),
    ("employee_id", LongType()),
    ("start_at", TimestampType()),
    ("end_at", TimestampType()),
    ("sport_type", StringType()),
    ("distance_m", DISTANCE),
    ("comment", StringType()),
    ("source", StringType()),
    ("created_at", TimestampType()),
)

# Activity as it travels in a change message: timestamps are ISO text and the
# distance is a double (the capture connector's double decimal handling).
CDC_PAYLOAD = _s(
    ("activity_id", LongType()),
    ("employee_id", LongType()),
    ("start_at", StringType()),
    ("end_at", StringType()),
    ("sport_type", StringType()),
    ("distance_m", DoubleType()),
    ("comment", StringType()),
    ("source", StringType()),
    ("created_at", StringType()),
    ("__op", StringType()),
    ("__table", StringType()),
    ("__source_ts_ms", LongType()),
)

CDC_ENVELOPE = StructType([StructField("payload", CDC_PAYLOAD, True)])

# Either shape of a change message: enveloped (``payload``) or bare.
CDC_ANY = StructType(list(CDC_PAYLOAD.fields) + [StructField("payload", CDC_PAYLOAD, True)])

# Raw broker record (Kafka source columns used here, or the landing twin).
BROKER_RECORD = _s(
    ("value", StringType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
)

BRONZE = StructType(
    list(CDC_PAYLOAD.fields)
    + [
        StructField("kafka_timestamp", TimestampType(), True),
        StructField("kafka_partition", IntegerType(), True),
        StructField("kafka_offset", LongType(), True),
        StructField("bronze_ingested_at", TimestampType(), True),
    ]
)

COMMUTE_DISTANCES = _s(
    ("employee_id", LongType()),
    ("distance_m", LongType()),
    ("api_error", StringType()),
)

BENEFIT_PARAMETERS = _s(
    ("parameter_name", StringType()),
    ("parameter_value", PARAM),
    ("valid_from", DateType()),
    ("valid_to", DateType()),
)

COMMUTE_VALIDATION = _s(
    ("employee_id", LongType()),
    ("home_address", StringType()),
    ("company_address", StringType()),
    ("commute_mode", StringType()),
    ("google_travel_mode", StringType()),
    ("distance_m", LongType()),
    ("distance_km", KM),
    ("threshold_km", KM),
    ("validation_status", StringType()),
    ("anomaly_reason", StringType()),
    ("api_error", StringType()),
    ("checked_at", TimestampType()),
)

DQ_RESULTS = _s(
    ("activity_id", LongType()),
    ("employee_id", LongType()),
    ("rule_name", StringType()),
    ("error_message", StringType()),
    ("detected_at", TimestampType()),
)

# 15-column serving projection and 14-column BI projection.
SERVING_COLUMNS = [
    "activity_id", "employee_id", "first_name", "last_name", "business_unit",
    "contract_type", "sport_type", "declared_sport", "activity_date", "start_ts",
    "end_ts", "duration_minutes", "distance_km", "source", "silver_ingested_at",
]
BI_COLUMNS = SERVING_COLUMNS[:-1]

