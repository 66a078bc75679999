"""Driver tables -> domain tables.

The test bench ships TPC-H-like parquet (``customer``, ``events``, ...). This
module derives the domain tables of the engine from them with plain column
expressions: every derived table grows with its source table and is computed
by the executors (no driver-side rows). The same mapping is written in DuckDB
SQL in ``stridelake.plans.oracle`` for the differential check.

The integer rules below (``% 10``, ``% 6``, ...) are the fixture's mapping of
driver columns to domain values; none of them drops a row. Keys that do not
match (unknown employees, stale sport rows, routing answers under an old badge)
are made by moving ids by ``MOVED``, outside the range of customers.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import constants as K
from ..functions.exprs import iso_text

# Pinned clocks of the fixture.
AS_OF = "2025-01-24 00:00:00"      # 12-month window: cut-off 2024-01-24
DQ_AS_OF = "2024-01-29 00:00:00"   # DQ05 fires for the last days of the data
COMPANY_ADDRESS = "Head office"
SNAPSHOT_STAMPS = ("2024-01-02 00:00:00", "2024-01-10 12:00:00", "2024-01-20 00:00:00")
MOVED = 1_000_000_000              # no customer has an id this large

_MEMO: dict[tuple, DataFrame] = {}


def _memo(fn):
    """Build each derived table once per session and directory. Only the
    lazy logical plan is kept - no data is cached; every query still reads
    and processes the whole tables. Reusing one plan object also lets Spark
    reuse an identical exchange within a query."""
    @functools.wraps(fn)
    def wrap(spark: SparkSession, sf_dir: str, *args):
        key = (id(spark), spark.conf.get("spark.app.id", ""), sf_dir.rstrip("/"), fn.__name__, args)
        if key not in _MEMO:
            _MEMO[key] = fn(spark, sf_dir, *args)
        return _MEMO[key]
    return wrap


@_memo
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_memo
def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current employee table: every customer."""
    c = _table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    mode = (F.when(key % 4 == 0, K.MODE_WALK)
            .when(key % 4 == 1, K.MODE_BIKE)
            .when(key % 4 == 2, "Transports en commun")
            .otherwise("véhicule thermique/électrique"))
    return (c.select(
                key.cast("long").alias("employee_id"),
                F.col("c_name").alias("last_name"),
                F.concat(F.lit("First"), (key % 97).cast("string")).alias("first_name"),
                F.date_add(F.lit("1960-01-01").cast("date"), ((key * 37) % 14000).cast("int")).alias("birth_date"),
                F.col("c_mktsegment").alias("business_unit"),
                F.date_add(F.lit("2000-01-01").cast("date"), ((key * 53) % 9500).cast("int")).alias("hire_date"),
                (F.lit(25000).cast("decimal(12,2)") + F.col("c_acctbal").cast("decimal(12,2)"))
                .cast("decimal(12,2)").alias("annual_gross_salary"),
                F.when(key % 13 == 0, "CDD").otherwise("CDI").alias("contract_type"),
                (F.lit(25) + key % 6).cast("int").alias("paid_leave_days"),
                F.concat(F.lit("Home "), key.cast("string")).alias("home_address"),
                mode.alias("commute_mode"),
            ))


@_memo
def former_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People who left (every supplier): in older results, not in ``employees``."""
    key = F.col("s_suppkey")
    return _table(spark, sf_dir, "supplier").select(
        (key + MOVED).cast("long").alias("employee_id"),
        F.col("s_name").alias("last_name"),
        F.concat(F.lit("Old"), (key % 97).cast("string")).alias("first_name"),
        F.concat(F.lit("Home "), key.cast("string")).alias("home_address"),
        F.when(key % 3 == 0, K.MODE_WALK).when(key % 3 == 1, K.MODE_BIKE)
        .otherwise("Transports en commun").alias("commute_mode"),
    )


@_memo
def employee_sports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sport row for every customer; every tenth one stands under an id that
    no employee has (so that employee has none)."""
    c = _table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    sport = (F.when(key % 6 == 1, "Runing")
             .when(key % 6 == 2, "Randonnée")
             .when(key % 6 == 3, "Tennis")
             .when(key % 6 == 4, "Triathlon")
             .when(key % 6 == 5, "Judo"))
    owner = F.when(key % 10 == 9, key + MOVED).otherwise(key)
    return c.select(owner.cast("long").alias("employee_id"), sport.alias("sport"))


@_memo
def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").try_cast("int")
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_add("MINUTE", k - 5, start)
    et = F.col("event_type")
    sport = (F.when(et == "error", F.when(eid % 10 == 0, "  ").when(eid % 10 == 1, "")
                    .when(eid % 10 != 2, "Runing"))
             .when(et == "click", "Running")
             .when(et == "view", "Randonnée")
             .when(et == "signup", "Judo")
             .when(et == "purchase", "Tennis"))
    metres = (F.col("value").cast("decimal(18,2)") * F.lit(100)).cast("decimal(18,2)")
    distance = (F.when(eid % 7 == 0, F.lit(None).cast("decimal(18,2)"))
                .when(eid % 50 == 0, (-metres).cast("decimal(18,2)"))
                .otherwise(metres))
    comment = (F.when(eid % 3 == 0, "Historique simulé")
               .when(eid % 3 == 1, " super "))
    source = F.when(eid % 5 == 0, K.LIVE_SOURCE).otherwise("simulation_historical")
    return e.select(
        eid.alias("activity_id"),
        F.when(eid % 13 == 0, F.col("user_id") + MOVED).otherwise(F.col("user_id"))
        .cast("long").alias("employee_id"),
        start.alias("start_at"),
        end.alias("end_at"),
        sport.alias("sport_type"),
        distance.cast(S.DISTANCE).alias("distance_m"),
        comment.alias("comment"),
        source.alias("source"),
        start.alias("created_at"),
    )


@_memo
def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of ``activities``: every row created (every 37th as a
    snapshot read), every 9th updated (+60 s, distance doubled), every 45th
    deleted (+120 s). One scan gives all changes of a row. Ordering columns are
    the ones a broker gives: partition (same key, same partition) and an offset
    that no other change has."""
    ms = (F.unix_micros("start_at") - F.pmod(F.unix_micros("start_at"), F.lit(1000))) / F.lit(1000)
    base = activities(spark, sf_dir).select(
        "*", ms.cast("long").alias("_ms"),
        F.pmod(F.col("employee_id"), F.lit(4)).cast("int").alias("kafka_partition"))
    eid, distance = F.col("activity_id"), F.col("distance_m")

    def change(op, delay: int, number: int, metres):
        return F.struct(op.alias("__op"), (F.col("_ms") + delay).alias("__source_ts_ms"),
                        (eid * 3 + number).alias("kafka_offset"), metres.alias("distance_m"))

    changes = F.filter(F.array(
        change(F.when(eid % 37 == 0, "r").otherwise("c"), 0, 0, distance),
        F.when(eid % 9 == 0, change(F.lit("u"), 60000, 1, (distance * 2).cast(S.DISTANCE))),
        F.when(eid % 45 == 0, change(F.lit("d"), 120000, 2, distance)),
    ), lambda x: x.isNotNull())
    kept = [c for c in base.columns if c not in ("distance_m", "_ms")]
    return base.select(*kept, F.inline(changes)).withColumn("__table", F.lit("activities"))


@_memo
def change_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cdc_log`` as three batches of typed versions: 0 the creations, 1 the
    changes of the first three days' activities, 2 all other changes. Every
    second update moves the activity by 40 days, every third one gives it to
    another employee, and every 81st creation arrives in batch 2, after its
    update."""
    log = cdc_log(spark, sf_dir)
    eid, start = F.col("activity_id"), F.col("start_at")
    update = F.col("__op") == "u"
    later = F.expr("INTERVAL 40 DAYS")
    batch = (F.when(F.col("__op").isin("c", "r"), F.when(eid % 81 == 0, 2).otherwise(0))
             .when(start < F.lit("2024-01-04").cast("timestamp"), 1).otherwise(2))
    moves = update & (eid % 18 == 0)
    return log.select(
        batch.alias("batch"), "activity_id",
        F.when(update & (eid % 27 == 0), F.col("employee_id") + 1).otherwise(F.col("employee_id")).alias("employee_id"),
        F.when(moves, start + later).otherwise(start).alias("start_at"),
        F.when(moves, F.col("end_at") + later).otherwise(F.col("end_at")).alias("end_at"),
        "sport_type", "distance_m", "__op", "__source_ts_ms", "kafka_partition", "kafka_offset",
    ).withColumn("activity_date", F.to_date("start_at"))


@_memo
def employee_versions(spark: SparkSession, sf_dir: str, step: int) -> DataFrame:
    """The employee table at three steps: at first every 17th employee stands
    under an old badge id, then all under their own, at last every 19th has left
    (under an id that no activity names)."""
    key = F.col("employee_id")
    moved = {0: F.when(key % 17 == 0, key + MOVED * 3).otherwise(key), 1: key,
             2: F.when(key % 19 == 0, key + MOVED * 4).otherwise(key)}[step]
    return employees(spark, sf_dir).withColumn("employee_id", moved)


@_memo
def cdc_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records carrying ``cdc_log`` as JSON text: mostly enveloped
    ``{"payload": {...}}``, some bare, some with a null payload, some garbage
    - the mix a change topic can carry."""
    log = cdc_log(spark, sf_dir)
    payload = F.struct(
        F.col("activity_id"),
        F.col("employee_id"),
        iso_text("start_at").alias("start_at"),
        iso_text("end_at").alias("end_at"),
        F.col("sport_type"),
        F.col("distance_m").cast("double").alias("distance_m"),
        F.col("comment"),
        F.col("source"),
        iso_text("created_at").alias("created_at"),
        F.col("__op"),
        F.col("__table"),
        F.col("__source_ts_ms"),
    )
    off = F.col("kafka_offset")
    value = (F.when(off % 89 == 0, F.lit("{not json"))
             .when(off % 97 == 0, F.lit('{"payload":null}'))
             .when(off % 4 == 1, F.to_json(payload))
             .otherwise(F.to_json(F.struct(payload.alias("payload")))))
    return log.select(
        value.alias("value"),
        F.lit("raw.activities").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        off.alias("offset"),
        F.timestamp_millis(F.col("__source_ts_ms")).alias("timestamp"),
    )


@_memo
def cdc_messages_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cdc_messages`` from a producer that has added fields: an object
    ``weather`` in every fifth message, and ``heart_rate`` in every seventh,
    a number at first and text in every 35th."""
    off = F.col("offset")
    added = F.concat_ws(
        ",", F.when(off % 35 == 0, F.lit('"heart_rate":"n/a"')).when(off % 7 == 0, F.concat(F.lit('"heart_rate":'), (60 + off % 90).cast("string"))),
        F.when(off % 5 == 0, F.concat(F.lit('"weather":{"temp":'), (off % 30).cast("string"), F.lit(',"sky":"clear"}'))))
    open_at = F.when(F.col("value").startswith('{"payload":{'), len('{"payload":{')).when(F.col("value").startswith('{"activity_id"'), 1)
    value = F.when(open_at.isNotNull() & (added != ""), F.concat(
        F.substring(F.col("value"), F.lit(1), open_at), added, F.lit(","), F.substring(F.col("value"), open_at + 1, F.length("value")))
    ).otherwise(F.col("value"))
    return cdc_messages(spark, sf_dir).withColumn("value", value)


@_memo
def employee_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three dated snapshots of the employee table: at the second one every
    fifth employee has another unit and every seventh is away; at the third
    these are back, and every eleventh has another contract."""
    key = F.col("employee_id")
    stamps = [F.lit(t).cast("timestamp").alias("stamp") for t in SNAPSHOT_STAMPS]
    moved = F.when(key % 5 == 0, "Moved unit").otherwise(F.col("business_unit"))
    dated = F.filter(F.array(
        F.struct(stamps[0], F.col("business_unit"), F.col("contract_type")),
        F.when(key % 7 != 0, F.struct(stamps[1], moved.alias("business_unit"), F.col("contract_type"))),
        F.struct(stamps[2], moved.alias("business_unit"),
                 F.when(key % 11 == 0, "Freelance").otherwise(F.col("contract_type")).alias("contract_type"))),
        lambda s: s.isNotNull())
    return employees(spark, sf_dir).select("employee_id", F.inline(dated))


@_memo
def staff_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staff table before a load: former employees, and the present ones,
    every sixth with another commute and every eighth under an old badge id."""
    key = F.col("employee_id")
    columns = ["employee_id", "home_address", "commute_mode"]
    now = employees(spark, sf_dir).select(
        F.when(key % 8 == 0, key + MOVED * 5).otherwise(key).alias("employee_id"), "home_address",
        F.when(key % 6 == 0, "Transports en commun").otherwise(F.col("commute_mode")).alias("commute_mode"))
    return now.unionByName(former_employees(spark, sf_dir).select(*columns))


@_memo
def commute_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing answers for current and former employees. Every tenth one of a
    current employee came in under an old badge id, so that employee has no
    answer; every 11th id has no route."""
    now = employees(spark, sf_dir).select("employee_id", F.when(
        F.col("employee_id") % 10 == 4, F.col("employee_id") + 2 * MOVED).otherwise(F.col("employee_id")).alias("badge"))
    old = former_employees(spark, sf_dir).select("employee_id", F.col("employee_id").alias("badge"))
    eid = F.col("employee_id")
    return now.unionByName(old).select(
        F.col("badge").alias("employee_id"),
        F.when(eid % 11 == 0, F.lit(None).cast("long"))
        .otherwise((eid.cast("long") * 7919) % 40000).alias("distance_m"),
        F.when(eid % 11 == 0, F.lit("no route found")).alias("api_error"),
    )


@_memo
def master_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee master data as raw CSV text cells, with the defects the
    cleaning step must absorb: padded ids, decimal text, comma decimals,
    blanks, junk."""
    c = _table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    ks = key.cast("string")
    emp_id = (F.when(key % 5 == 0, F.concat(F.lit(" "), ks, F.lit(" ")))
              .when(key % 5 == 1, F.concat(ks, F.lit(".0")))
              .otherwise(ks))
    salary_txt = (F.lit(25000).cast("decimal(12,2)") + F.col("c_acctbal").cast("decimal(12,2)")
                  ).cast("decimal(12,2)").cast("string")
    salary = (F.when(key % 7 == 0, F.replace(salary_txt, F.lit("."), F.lit(",")))
              .when(key % 7 == 1, F.lit(" "))
              .when(key % 7 == 2, F.lit("n/a"))
              .otherwise(salary_txt))
    leave = (F.when(key % 4 == 0, F.concat((25 + key % 6).cast("string"), F.lit(".0")))
             .when(key % 4 == 1, F.concat((25 + key % 6).cast("string"), F.lit(",5")))
             .when(key % 4 == 2, F.lit(""))
             .otherwise((25 + key % 6).cast("string")))
    unit = F.when(key % 9 == 0, F.lit("\t")).otherwise(F.concat(F.col("c_mktsegment"), F.lit(" ")))
    return c.select(
        emp_id.alias("employee_id"),
        F.col("c_name").alias("last_name"),
        unit.alias("business_unit"),
        salary.alias("annual_gross_salary"),
        leave.alias("paid_leave_days"),
    )


@_memo
def master_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored master table before a load: every customer with the stamp of
    its first load."""
    return employees(spark, sf_dir).select(
        "employee_id", "last_name", "business_unit", "annual_gross_salary", "paid_leave_days",
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("employee_id") % 1000).cast("int")).alias("ingested_at"))


@_memo
def master_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of typed rows, one for each order line: its customer's row with a
    new unit and salary (several versions of a customer, the highest order
    wins). Every 50th order is of a person not known before, and so are all
    orders of every fourth customer, whose own stored row stays untouched."""
    o = _table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.when(key % 50 == 0, key + MOVED).when(cust % 4 == 0, cust + 2 * MOVED)
        .otherwise(cust).cast("long").alias("employee_id"),
        F.concat(F.lit("Name "), cust.cast("string")).alias("last_name"),
        F.concat(F.lit("Unit "), (key % 7).cast("string")).alias("business_unit"),
        (F.lit(30000) + key % 1000).cast("decimal(12,2)").alias("annual_gross_salary"),
        (F.lit(25) + key % 5).cast("int").alias("paid_leave_days"),
        F.lit("2025-01-24").cast("date").alias("ingested_at"),
        key.cast("long").alias("line"))


@_memo
def sports_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sport master data as raw CSV text cells: padded and decimal ids,
    empty, blank and padded sport names."""
    c = _table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    ks = key.cast("string")
    emp_id = F.when(key % 3 == 0, F.concat(ks, F.lit(".0"))).otherwise(F.concat(F.lit(" "), ks))
    sport = (F.when(key % 6 == 0, F.lit(""))
             .when(key % 6 == 1, F.lit(" Runing "))
             .when(key % 6 == 2, F.lit("Randonnée"))
             .when(key % 6 == 3, F.lit("\t"))
             .when(key % 6 == 4, F.lit("Tennis de table"))
             .otherwise(F.lit(None).cast("string")))
    return c.select(emp_id.alias("employee_id"), sport.alias("sport"))
