import json
import os


from stridelake.sources.cdc import read_cdc_stream, write_landing
from stridelake.sources.tables import read_table
from stridelake.streaming.bronze import start_bronze
from stridelake.streaming.notifications import start_notifications
from stridelake.streaming.reference_snapshots import start_reference_snapshots
from stridelake.streaming.silver import compact_current, make_batch_writer, start_silver

TOPIC = "raw.activities"
RAW = "value string, topic string, partition int, offset long, timestamp timestamp"


def _msg(aid, op="c", ts=1000, emp=1, source="simulation_historical", **kw):
    p = {"activity_id": aid, "employee_id": emp, "start_at": "2024-01-01T10:00:00Z",
         "end_at": "2024-01-01T10:45:00Z", "sport_type": "Running", "distance_m": 5000.0,
         "comment": None, "source": source, "created_at": "2024-01-01T10:00:00Z",
         "__op": op, "__table": "activities", "__source_ts_ms": ts}
    p.update(kw)
    return json.dumps({"payload": p})


def _land(spark, path, rows):
    write_landing(spark.createDataFrame(rows, RAW), path)


def _refs(spark):
    emp = spark.createDataFrame([(1, "Ana", "Lopez", "R&D", "CDI", None)],
                                "employee_id int, first_name string, last_name string, business_unit string, "
                                "contract_type string, annual_gross_salary decimal(12,2)")
    sp = spark.createDataFrame([(1, "Runing")], "employee_id int, sport string")
    return emp, sp


def test_bronze_restart_adds_nothing(spark, tmp):
    landing, bronze, ck = (os.path.join(tmp, x) for x in ("landing", "bronze", "ck"))
    _land(spark, landing, [(_msg(1), TOPIC, 0, 1, None), (_msg(2), TOPIC, 0, 2, None), ("bad", TOPIC, 0, 3, None)])
    for _ in range(2):
        q = start_bronze(read_cdc_stream(spark, TOPIC, source="landing", landing_path=landing),
                         bronze, ck, trigger={"availableNow": True})
        q.awaitTermination()
    df = read_table(spark, bronze)
    assert df.count() == 3 and df.where("activity_id IS NULL").count() == 1
    _land(spark, landing, [(_msg(1, op="u", ts=2000), TOPIC, 0, 4, None)])
    q = start_bronze(read_cdc_stream(spark, TOPIC, source="landing", landing_path=landing),
                     bronze, ck, trigger={"availableNow": True})
    q.awaitTermination()
    assert read_table(spark, bronze).count() == 4


def test_silver_stream_and_replay_is_idempotent(spark, tmp):
    landing, bronze, silver = (os.path.join(tmp, x) for x in ("landing", "bronze", "silver"))
    _land(spark, landing, [(_msg(1), TOPIC, 0, 1, None), (_msg(1, op="u", ts=2000, distance_m=7000.0), TOPIC, 0, 2, None),
                           (_msg(2, emp=5), TOPIC, 0, 3, None)])
    start_bronze(read_cdc_stream(spark, TOPIC, source="landing", landing_path=landing), bronze,
                 os.path.join(tmp, "ck_b"), trigger={"availableNow": True}).awaitTermination()
    emp, sp = _refs(spark)
    q = start_silver(spark, bronze, silver, os.path.join(tmp, "ck_s"), lambda s: emp, lambda s: sp,
                     trigger={"availableNow": True})
    q.awaitTermination()
    log = read_table(spark, silver)
    assert log.count() == 3
    r = log.where("activity_id = 2").collect()[0]
    assert r.first_name is None and r.duration_minutes == 45.0 and str(r.distance_km) == "5.00"
    assert log.where("activity_id = 1").select("declared_sport").first()[0] == "Runing"
    # replaying the same batch id replaces its partition
    writer = make_batch_writer(silver, lambda s: emp, lambda s: sp)
    batch_ids = [r.batch_id for r in log.select("batch_id").distinct().collect()]
    writer(read_table(spark, bronze), batch_ids[0])
    assert read_table(spark, silver).count() == 3
    out = os.path.join(tmp, "current_v1")
    compact_current(spark, silver, out)
    cur = {r.activity_id: r for r in read_table(spark, out).collect()}
    assert set(cur) == {1, 2} and str(cur[1].distance_km) == "7.00"


def test_notification_stream(spark, tmp):
    landing = os.path.join(tmp, "landing")
    _land(spark, landing, [(_msg(1, source="live", comment="bravo"), TOPIC, 0, 1, None),
                           (_msg(2), TOPIC, 0, 2, None), ("{oops", TOPIC, 0, 3, None)])
    emp, _ = _refs(spark)
    q = start_notifications(read_cdc_stream(spark, TOPIC, source="landing", landing_path=landing),
                            os.path.join(tmp, "notif"), os.path.join(tmp, "bad"), os.path.join(tmp, "ck"),
                            lambda s: emp, trigger={"availableNow": True})
    q.awaitTermination()
    notes = read_table(spark, os.path.join(tmp, "notif")).collect()
    assert len(notes) == 1 and notes[0].message.startswith("🏃 Bravo Ana Lopez ! Tu viens de terminer")
    assert read_table(spark, os.path.join(tmp, "bad")).count() == 1


def test_reference_snapshots(spark, tmp):
    landing = os.path.join(tmp, "landing")
    src = os.path.join(tmp, "employees_src")
    spark.createDataFrame([(2, "b"), (1, "a")], "employee_id int, name string").write.parquet(src)
    _land(spark, landing, [("{}", "raw.employees", 0, 1, None),
                           ("{}", "raw.employees", 0, 2, None),
                           ("{}", "other", 0, 1, None)])
    tables = {"raw.employees": {"archive_prefix": os.path.join(tmp, "archive", "employees"),
                                           "current_path": os.path.join(tmp, "current", "employees"),
                                           "order_by": "employee_id", "path": src}}
    q = start_reference_snapshots(
        read_cdc_stream(spark, list(tables) + ["other"], source="landing", landing_path=landing),
        tables, os.path.join(tmp, "ck"), read=lambda s, cfg: s.read.parquet(cfg["path"]),
        trigger={"availableNow": True})
    q.awaitTermination()
    archives = os.listdir(os.path.join(tmp, "archive"))
    assert len(archives) == 1 and archives[0].startswith("employees_")
    from stridelake.sources.reference import current_files
    cur = spark.read.option("header", True).csv(current_files(spark, os.path.join(tmp, "current", "employees")))
    assert [r.employee_id for r in cur.collect()] == ["1", "2"]


def test_silver_stream_upserts_serving_table_on_derby(spark, tmp):
    import uuid

    from stridelake.sinks import jdbc as J
    landing, bronze, silver = (os.path.join(tmp, x) for x in ("landing", "bronze", "silver"))
    url = f"jdbc:derby:memory:s{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    probe = "SELECT 1 AS ok FROM SYSIBM.SYSDUMMY1"
    cols = ("activity_id BIGINT, employee_id INT, first_name VARCHAR(50), last_name VARCHAR(50), "
            "business_unit VARCHAR(50), contract_type VARCHAR(10), sport_type VARCHAR(50), "
            "declared_sport VARCHAR(50), activity_date DATE, start_ts TIMESTAMP, end_ts TIMESTAMP, "
            "duration_minutes DOUBLE, distance_km DECIMAL(18,2), source VARCHAR(40), silver_ingested_at TIMESTAMP")
    J.execute(spark, url, f"CREATE TABLE serving ({cols.replace('activity_id BIGINT', 'activity_id BIGINT PRIMARY KEY')})",
              props, probe)
    J.execute(spark, url, f"CREATE TABLE staging ({cols}, change_op VARCHAR(5))", props, probe)
    _land(spark, landing, [(_msg(1), TOPIC, 0, 1, None), (_msg(1, op="u", ts=2000, distance_m=9000.0), TOPIC, 0, 2, None),
                           (_msg(2), TOPIC, 0, 3, None), (_msg(3), TOPIC, 0, 4, None),
                           (_msg(3, op="d", ts=3000), TOPIC, 0, 5, None), ("{broken", TOPIC, 0, 6, None)])
    start_bronze(read_cdc_stream(spark, TOPIC, source="landing", landing_path=landing), bronze,
                 os.path.join(tmp, "ck_b"), trigger={"availableNow": True}).awaitTermination()
    emp, sp = _refs(spark)
    serving = {"url": url, "table": "serving", "staging": "staging", "props": props, "probe_query": probe}
    bad = os.path.join(tmp, "bad")
    writer = make_batch_writer(silver, lambda s: emp, lambda s: sp, serving_jdbc=serving, malformed_path=bad)
    writer(read_table(spark, bronze).where("activity_id is null"), 9)      # a first batch without a valid row
    writer(read_table(spark, bronze), 0)
    writer(read_table(spark, bronze), 0)          # replay: same partition, same serving rows
    got = {r.ACTIVITY_ID: r for r in spark.read.format("jdbc").option("url", url)
           .option("dbtable", "serving").options(**props).load().collect()}
    assert set(got) == {1, 2} and str(got[1].DISTANCE_KM) == "9.00" and got[1].FIRST_NAME == "Ana"
    assert read_table(spark, silver).count() == 5 and read_table(spark, bad).where("batch_id = 0").count() == 1
    from stridelake.streaming.silver import publish_current, read_current
    cur = os.path.join(tmp, "published")
    publish_current(spark, silver, cur, 1)
    assert {r.activity_id for r in read_current(spark, cur).collect()} == set(got)   # lake and table agree


def test_incremental_current_equals_full_compaction(spark, tmp):
    from stridelake.operators.cdc import current_state
    from stridelake.streaming.silver import publish_current, read_current
    log, cur = os.path.join(tmp, "log"), os.path.join(tmp, "cur")
    cols = ("activity_id long, __op string, __source_ts_ms long, kafka_partition int, kafka_offset long, "
            "activity_date date, v string")
    import datetime as dt

    from stridelake.sinks.lake import write_log_partition
    day = dt.date(2024, 1, 1)
    batches = [[(1, "c", 10, 0, 1, day, "a"), (2, "c", 10, 0, 2, day, "b"), (3, "c", 10, 0, 3, day, "c")],
               [(1, "u", 20, 0, 4, day, "a2"), (2, "d", 30, 0, 5, day, "b")],
               [(2, "u", 25, 0, 6, day, "late"), (3, "u", 40, 0, 7, day, "c2"), (4, "c", 5, 0, 8, day, "d")],
               [(3, "d", 50, 0, 9, day, "c2")]]
    for i, rows in enumerate(batches):
        write_log_partition(spark.createDataFrame(rows, cols), log, i)
        publish_current(spark, log, cur, i + 1)
        want = current_state(read_table(spark, log).drop("batch_id"))
        assert sorted(map(str, read_current(spark, cur).select(*want.columns).collect())) == \
            sorted(map(str, want.collect()))
    publish_current(spark, log, cur, 99)         # nothing new: the same state again
    assert {r.v for r in read_current(spark, cur).collect()} == {"a2", "d"}


def test_compacted_current_feeds_benefits_with_partition_pruning(spark, tmp):
    from stridelake.operators import benefits as B
    from stridelake.operators.silver import as_activities
    landing, bronze, silver, cur = (os.path.join(tmp, x) for x in ("landing", "bronze", "silver", "cur"))
    _land(spark, landing, [(_msg(1), TOPIC, 0, 1, None), (_msg(2, start_at="2022-01-01T10:00:00Z"), TOPIC, 0, 2, None)])
    start_bronze(read_cdc_stream(spark, TOPIC, source="landing", landing_path=landing), bronze,
                 os.path.join(tmp, "ck_b"), trigger={"availableNow": True}).awaitTermination()
    emp, sp = _refs(spark)
    make_batch_writer(silver, lambda s: emp, lambda s: sp)(read_table(spark, bronze), 0)
    compact_current(spark, silver, cur)
    acts = as_activities(read_table(spark, cur))
    counts = B.activity_counts_12m(acts, "2024-06-01 00:00:00")
    assert {r.employee_id: r._n for r in counts.collect()} == {1: 1}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(activity_date" in plan and "activity_date#" in plan


def test_publish_and_read_current_versions(spark, tmp):
    from stridelake.streaming.silver import publish_current, read_current
    landing, bronze, silver, root = (os.path.join(tmp, x) for x in ("landing", "bronze", "silver", "current"))
    _land(spark, landing, [(_msg(1), TOPIC, 0, 1, None), (_msg(2), TOPIC, 0, 2, None)])
    start_bronze(read_cdc_stream(spark, TOPIC, source="landing", landing_path=landing), bronze,
                 os.path.join(tmp, "ck_b"), trigger={"availableNow": True}).awaitTermination()
    emp, sp = _refs(spark)
    writer = make_batch_writer(silver, lambda s: emp, lambda s: sp)
    writer(read_table(spark, bronze), 0)
    publish_current(spark, silver, root, 1)
    assert read_current(spark, root).count() == 2
    _land(spark, landing, [(_msg(2, op="d", ts=5000), TOPIC, 0, 3, None)])
    start_bronze(read_cdc_stream(spark, TOPIC, source="landing", landing_path=landing), bronze,
                 os.path.join(tmp, "ck_b"), trigger={"availableNow": True}).awaitTermination()
    writer(read_table(spark, bronze).where("kafka_offset = 3"), 1)
    publish_current(spark, silver, root, 2)
    assert [r.activity_id for r in read_current(spark, root).collect()] == [1]
    assert read_table(spark, os.path.join(root, "v1")).count() == 2      # previous version intact


def test_duplicate_reference_rows_do_not_duplicate_activities(spark):
    from stridelake.operators.silver import enrich
    bronze = spark.createDataFrame([(1, 1, "2024-01-01T10:00:00Z", "2024-01-01T11:00:00Z", 1000.0)],
                                   "activity_id long, employee_id long, start_at string, end_at string, "
                                   "distance_m double")
    emp = spark.createDataFrame([(1, "Ana", "A", "R&D", "CDI", None), (1, "Ana", "B", "R&D", "CDI", None)],
                                "employee_id int, first_name string, last_name string, business_unit string, "
                                "contract_type string, annual_gross_salary decimal(12,2)")
    sp = spark.createDataFrame([(1, "Judo"), (1, "Judo")], "employee_id int, sport string")
    rows = enrich(bronze, emp, sp).collect()
    assert len(rows) == 1 and rows[0].last_name == "B"
    assert enrich(bronze, emp, sp, dedupe_references=False).count() == 4
