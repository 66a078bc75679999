"""Streams with state: records delivered again, bursts of reference changes,
replays of Silver batches, the keyed current table."""

import json
import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from stridelake.operators.commute import validate_commutes
from stridelake.sinks import jdbc as J
from stridelake.sinks.keyed import KeyedTable
from stridelake.sinks.lake import publish_reference
from stridelake.sources.cdc import read_cdc_stream, write_landing
from stridelake.sources.files import names
from stridelake.sources.reference import PinnedReferences, read_employees_ref, read_sports_ref
from stridelake.sources.tables import read_table
from stridelake.streaming.bronze import start_bronze
from stridelake.streaming.reference_snapshots import start_reference_snapshots
from stridelake.streaming.silver import compact_current, make_batch_writer

TOPIC = "raw.activities"


def record(aid, offset, second, op="c", day="2024-01-01", **more):
    payload = {"activity_id": aid, "employee_id": 1, "start_at": f"{day}T10:00:00Z", "end_at": f"{day}T10:45:00Z",
               "sport_type": "Running", "distance_m": 5000.0, "comment": None, "source": "live", "created_at": f"{day}T10:00:00Z",
               "__op": op, "__table": "activities", "__source_ts_ms": 1000 * offset, **more}
    return (json.dumps({"payload": payload}), TOPIC, 0, offset, f"2024-01-01 10:{second // 60:02d}:{second % 60:02d}")


def land(spark, path, rows):
    df = spark.createDataFrame(rows, "value string, topic string, partition int, offset long, timestamp string")
    write_landing(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")), path)


def test_records_delivered_again_are_dropped_across_batches_and_restarts(spark, tmp):
    landing, bronze, ck = (os.path.join(tmp, x) for x in ("landing", "bronze", "ck"))

    def run():
        start_bronze(read_cdc_stream(spark, TOPIC, source="landing", landing_path=landing), bronze, ck,
                     trigger={"availableNow": True}, once_within="10 minutes", keep_unknown=True).awaitTermination()
        return sorted(r.kafka_offset for r in read_table(spark, bronze).collect())

    land(spark, landing, [record(1, 1, 0), record(1, 1, 0), record(2, 2, 10, extra=1)])
    assert run() == [1, 2]
    land(spark, landing, [record(2, 2, 10, extra=1), record(3, 3, 20), record(1, 1, 0)])        # after a restart
    assert run() == [1, 2, 3]
    land(spark, landing, [record(4, 4, 30), (*record(3, 3, 25)[:2], 1, 3, "2024-01-01 10:00:25")])  # another partition
    assert run() == [1, 2, 3, 3, 4]
    assert {r.kafka_offset: r.unknown_fields for r in read_table(spark, bronze).collect()}[2] == '{"extra":1}'


def test_a_burst_over_several_triggers_gives_one_snapshot(spark, tmp):
    landing = os.path.join(tmp, "landing")
    ref = os.path.join(tmp, "ref")
    spark.createDataFrame([(1, "a")], "employee_id int, name string").write.parquet(ref)
    tables = {"raw.employees": {"archive_prefix": f"{tmp}/arch/employees", "current_path": f"{tmp}/cur", "order_by": "employee_id"},
              "raw.sports": {"archive_prefix": f"{tmp}/arch/sports", "current_path": f"{tmp}/cur_s", "order_by": "employee_id"}}
    os.makedirs(landing)
    q = start_reference_snapshots(read_cdc_stream(spark, list(tables), source="landing", landing_path=landing), tables,
                                  f"{tmp}/ck", debounce_seconds=6, read=lambda s, cfg: s.read.parquet(ref),
                                  trigger={"processingTime": "300 milliseconds"}, trailing=True)
    try:
        for i in range(5):                                             # a burst over at least five triggers
            land(spark, landing, [("x", "raw.employees", 0, i, "2024-01-01 10:00:00")])
            time.sleep(1)
        assert names(spark, f"{tmp}/arch") == []                       # not in the middle of the burst
        end = time.time() + 60
        while not names(spark, f"{tmp}/cur/_versions") and time.time() < end:
            time.sleep(0.5)
        time.sleep(3)
    finally:
        q.stop()
    assert len([n for n in names(spark, f"{tmp}/arch") if n.startswith("employees_")]) == 1
    assert len(names(spark, f"{tmp}/arch")) == 1


@pytest.fixture()
def bronze_batches(spark, tmp):
    """Three Bronze batches of the same three activities."""
    out = []
    steps = [[record(1, 1, 0), record(2, 2, 0, day="2024-01-02"), record(3, 3, 0, day="2024-01-03")],
             [record(1, 4, 0, "u", distance_m=7000.0), ("{bad", TOPIC, 0, 5, "2024-01-01 10:00:00")],
             [record(3, 6, 0, "d", day="2024-01-03"), record(2, 7, 0, "u", day="2024-01-09")]]
    from stridelake.operators.cdc import decode_cdc

    for i, rows in enumerate(steps):
        df = spark.createDataFrame(rows, "value string, topic string, partition int, offset long, timestamp string")
        decode_cdc(df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))).write.parquet(f"{tmp}/bronze{i}")
        out.append(spark.read.parquet(f"{tmp}/bronze{i}"))
    return out


def _publish(spark, tmp, unit, stamp):
    people = spark.createDataFrame([("1", "Ana", "Lopez", unit, "CDI", "30000")],
                                   "employee_id string, first_name string, last_name string, business_unit string, contract_type string, annual_gross_salary string")
    publish_reference(people, f"{tmp}/arch/employees", f"{tmp}/employees", stamp)


def test_silver_keeps_current_table_and_replays_with_the_version_it_read(spark, tmp, bronze_batches):
    _publish(spark, tmp, "R&D", "20240101T000000000000Z")
    publish_reference(spark.createDataFrame([("1", "Judo")], "employee_id string, sport string"), f"{tmp}/arch/sports",
                      f"{tmp}/sports", "20240101T000000000000Z")
    pinned = PinnedReferences(f"{tmp}/pins", {"employees": f"{tmp}/employees", "sports": f"{tmp}/sports"})
    write = make_batch_writer(f"{tmp}/silver", read_employees_ref, read_sports_ref, malformed_path=f"{tmp}/malformed",
                              pinned=pinned, current_root=f"{tmp}/current")
    write(bronze_batches[0], 0)
    _publish(spark, tmp, "Sales", "20240102T000000000000Z")
    write(bronze_batches[1], 1)
    write(bronze_batches[0], 0)                                        # a replay, after the new snapshot
    write(bronze_batches[2], 2)
    units = {r.kafka_offset: r.business_unit for r in read_table(spark, f"{tmp}/silver").collect()}
    assert units == {1: "R&D", 2: "R&D", 3: "R&D", 4: "Sales", 6: "Sales", 7: "Sales"}
    assert read_table(spark, f"{tmp}/malformed").count() == 1
    schema = spark.read.parquet(f"{tmp}/silver/batch_id=0").schema
    table = KeyedTable(spark, f"{tmp}/current", schema)
    assert table.versions() == [0, 1, 2]                               # the replay changed nothing
    compact_current(spark, f"{tmp}/silver", f"{tmp}/full")
    columns = [c for c in schema.names if c != "silver_ingested_at"]
    same = [sorted(map(str, df.select(*columns).collect())) for df in (table.read(), read_table(spark, f"{tmp}/full"))]
    assert same[0] == same[1] and table.read().count() == 2
    assert sorted(table.manifest()) == ["activity_date=2024-01-01", "activity_date=2024-01-03", "activity_date=2024-01-09"]


# --- serving -------------------------------------------------------------------------------

def test_an_older_change_of_a_later_batch_does_not_win():
    """The statement, run by the SQL engine that runs the oracles."""
    con = duckdb.connect()
    con.sql("CREATE TABLE target (k BIGINT PRIMARY KEY, v VARCHAR, ts BIGINT, off BIGINT)")
    con.sql("CREATE TABLE staging (k BIGINT, v VARCHAR, ts BIGINT, off BIGINT, change_op VARCHAR)")
    con.sql("INSERT INTO target VALUES (1, 'new', 9, 1), (2, 'old', 3, 1), (3, 'none', NULL, NULL), (4, 'tie', 5, 5), (5, 'stay', 7, 2)")
    con.sql("INSERT INTO staging VALUES (1, 'late', 8, 7, 'u'), (2, 'newer', 3, 2, 'u'), (3, 'some', 1, 1, 'u'), (4, 'again', 5, 5, 'u'), "
            "(5, 'late', 7, 1, 'd'), (6, 'made', 1, 1, 'c'), (7, 'never', 1, 1, 'd')")
    columns = ["k", "v", "ts", "off"]
    for _ in range(2):
        con.sql(J.merge_statement("target", "staging", ["k"], columns, op="change_op", order=["ts", "off"]))
    assert con.sql("SELECT k, v FROM target ORDER BY k").fetchall() == [
        (1, "new"), (2, "newer"), (3, "some"), (4, "again"), (5, "stay"), (6, "made")]
    plain = J.merge_statement("target", "staging", ["k"], columns, op="change_op")
    assert "s.ts > t.ts" not in plain


@pytest.mark.parametrize("versions", [False, True])
def test_serving_rows_carry_their_version(spark, monkeypatch, versions):
    """What is staged and merged, without a database."""
    from stridelake import schemas as S

    seen = {}
    monkeypatch.setattr(J, "write_staging", lambda df, url, table, props=None: (seen.update(rows=df.collect(), columns=df.columns)))
    monkeypatch.setattr(J, "execute", lambda spark, url, statement, props=None, probe_query="": seen.update(sql=statement))
    rows = [(1, "c", 5, 0, 1), (1, "u", 6, 0, 2), (2, "d", 7, 0, 3)]
    silver = spark.createDataFrame(rows, "activity_id long, __op string, __source_ts_ms long, kafka_partition int, kafka_offset long")
    silver = silver.select("*", *[F.lit(None).cast("string").alias(c) for c in S.SERVING_COLUMNS if c != "activity_id"])
    assert J.upsert_serving(silver, "jdbc:none", "target", "staging", versions) == 2
    order = ["source_ts_ms", "kafka_partition", "kafka_offset"] if versions else []
    assert seen["columns"] == [*S.SERVING_COLUMNS, *order, J.OP_COLUMN]
    assert sorted((r.activity_id, r[J.OP_COLUMN]) for r in seen["rows"]) == [(1, "u"), (2, "d")]
    assert ("s.source_ts_ms > t.source_ts_ms" in seen["sql"]) == versions


def test_writing_does_not_narrow_the_stage_before_it(spark):
    seen = J._writer(spark.range(0, 1000, 1, 64), "jdbc:none", "t", None, connections=4)._df
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "RoundRobinPartitioning(4)" in plan.replace("roundrobinpartitioning", "RoundRobinPartitioning") \
        or "REPARTITION_BY_NUM" in plan


def test_one_row_for_an_employee_whose_routing_answers_repeat(spark):
    people = spark.createDataFrame([(1, "h", "Marche/running"), (2, "h", "Marche/running"), (3, "h", "Marche/running")],
                                   "employee_id long, home_address string, commute_mode string")
    answers = spark.createDataFrame([(1, 99000, None), (1, 1000, None), (1, None, "busy"), (2, None, "b"), (2, None, "a"), (3, 5000, None)],
                                    "employee_id long, distance_m long, api_error string")
    for scope in ("all", "requested"):
        got = sorted((r.employee_id, r.distance_m, r.validation_status, r.api_error)
                     for r in validate_commutes(people, answers, as_of="2024-01-01", scope=scope).collect())
        assert got == [(1, 1000, "VALID", None), (2, None, "ERROR", "a"), (3, 5000, "VALID", None)]


def test_sums_keep_six_decimals(spark):
    from decimal import Decimal

    from stridelake.operators.benefits import employee_activity_12m

    people = spark.createDataFrame([(1, "a", "b")], "employee_id long, first_name string, last_name string")
    runs = spark.createDataFrame([(1, 1, "2024-06-01", "0.001"), (2, 1, "2024-06-01", "0.003")],
                                 "activity_id long, employee_id long, start_at string, distance_m string")
    runs = runs.withColumn("start_at", F.col("start_at").cast("timestamp")).withColumn("distance_m", F.col("distance_m").cast("decimal(18,6)"))
    assert employee_activity_12m(people, runs, "2024-07-01").first()["distance_m_12m"] == Decimal("0.004000")
