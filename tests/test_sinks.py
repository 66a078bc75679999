import os
import uuid

from stridelake import schemas as S
from stridelake.sinks import jdbc as J
from stridelake.sinks import lake as L
from stridelake.sources.reference import current_files, load_employees, read_employees_ref
from stridelake.sources.tables import ensure_table, read_table


def test_export_sorted_parallel_csv(spark, tmp):
    df = spark.range(1000).selectExpr(*[f"cast(id * 7 % 1000 as long) as {c}" if c == "activity_id"
                                        else f"cast(null as string) as {c}" for c in S.BI_COLUMNS])
    out = os.path.join(tmp, "bi")
    L.export_bi_csv(df, out)
    parts = sorted(p for p in os.listdir(out) if p.startswith("part-"))
    ids = []
    for p in parts:
        with open(os.path.join(out, p), encoding="utf-8") as fh:
            lines = fh.read().splitlines()
        assert lines[0].startswith("activity_id,employee_id")
        ids += [int(line.split(",")[0]) for line in lines[1:]]
    assert ids == sorted(ids) and len(ids) == 1000


def test_observed_write_and_log_partition(spark, tmp):
    out = os.path.join(tmp, "t")
    assert L.observed_write(spark.range(42), out) == 42
    log = os.path.join(tmp, "log")
    L.write_log_partition(spark.range(3), log, 0)
    L.write_log_partition(spark.range(5), log, 1)
    L.write_log_partition(spark.range(3), log, 0)
    assert read_table(spark, log).count() == 8


def test_ensure_table_and_publish_reference(spark, tmp):
    p = os.path.join(tmp, "bronze")
    ensure_table(spark, p, S.BRONZE)
    assert read_table(spark, p).count() == 0 and "kafka_offset" in read_table(spark, p).columns
    df = spark.createDataFrame([(1, "a")], "employee_id int, name string")
    arch = L.publish_reference(df, os.path.join(tmp, "arch", "employees"), os.path.join(tmp, "cur"),
                               stamp="20240101T000000000000Z")
    assert arch.endswith("employees_20240101T000000000000Z")
    assert spark.read.option("header", True).csv(current_files(spark, os.path.join(tmp, "cur"))).count() == 1


def test_reference_snapshot_keeps_every_cell(spark, tmp):
    cells = ['say "hi", ok', "two\nlines", "a,b;c", None, "", " padded ", "back\\slash", "é"]
    df = spark.createDataFrame([(9007199254740993 + i, c, str(30000 + i)) for i, c in enumerate(cells)],
                               "employee_id long, home_address string, annual_gross_salary string")
    cur = os.path.join(tmp, "cur")
    L.publish_reference(df.limit(2), os.path.join(tmp, "arch", "e"), cur, stamp="20240101T000000000000Z")
    L.publish_reference(df, os.path.join(tmp, "arch", "e"), cur, stamp="20240102T000000000000Z", order_by="employee_id")
    from stridelake.sources.reference import _csv
    for files in (cur, os.path.join(tmp, "arch", "e_20240102T000000000000Z")):
        got = {r.employee_id: r.home_address for r in _csv(spark, files).collect()}
        assert got == {str(9007199254740993 + i): c for i, c in enumerate(cells)}
    loaded = {r.employee_id for r in load_employees(spark, cur).collect()}
    assert loaded == {9007199254740993 + i for i in range(len(cells))}


def test_partitioned_overwrite_leaves_no_stale_partition(spark, tmp):
    path = os.path.join(tmp, "t")
    L.overwrite_table(spark.range(10).selectExpr("id", "id % 3 as p"), path, partition_by=["p"])
    L.overwrite_table(spark.range(4).selectExpr("id", "0 as p"), path, partition_by=["p"])
    assert read_table(spark, path).count() == 4


def test_merge_deletes_keys_whose_newest_change_is_a_delete(spark, tmp):
    url = f"jdbc:derby:memory:db{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    run = lambda sql: J.execute(spark, url, sql, props, probe_query=PROBE)
    run("CREATE TABLE serving (activity_id BIGINT PRIMARY KEY, v VARCHAR(10))")
    run("CREATE TABLE staging (activity_id BIGINT, v VARCHAR(10), change_op VARCHAR(5))")
    run("INSERT INTO serving VALUES (1, 'old'), (2, 'gone')")
    batch = spark.createDataFrame([(1, "new", "u", 2), (2, "gone", "d", 3), (3, "never", "c", 1), (3, "never", "d", 4),
                                   (4, "made", "c", 5)], "activity_id long, v string, __op string, kafka_offset long")
    for _ in range(2):
        J.upsert(batch, url, "serving", "staging", ["activity_id"], order=["kafka_offset"],
                 columns=["activity_id", "v"], props=props, probe_query=PROBE, op="__op")
    got = spark.read.format("jdbc").option("url", url).option("dbtable", "serving").options(**props).load()
    assert sorted((r.ACTIVITY_ID, r.V) for r in got.collect()) == [(1, "new"), (4, "made")]


def test_csv_master_load_with_bom(spark, tmp):
    path = os.path.join(tmp, "employees.csv")
    with open(path, "w", encoding="utf-8-sig") as fh:
        fh.write("employee_id,last_name,first_name,birth_date,business_unit,hire_date,annual_gross_salary,"
                 "contract_type,paid_leave_days,home_address,commute_mode\n")
        fh.write('12,Durand,Léa,1990-01-02,R&D,2020-03-01,"30940,5",CDI,29.0,"1 rue A, Paris",Marche/running\n')
        fh.write(" 13 ,  , Paul ,,Finance,,n/a,CDD,,  ,\n")
    rows = {r.employee_id: r for r in load_employees(spark, path).collect()}
    assert str(rows[12].annual_gross_salary) == "30940.50" and rows[12].paid_leave_days == 29
    assert rows[12].home_address == "1 rue A, Paris" and rows[12].first_name == "Léa"
    assert rows[13].last_name is None and rows[13].first_name == "Paul"
    assert rows[13].annual_gross_salary is None and rows[13].commute_mode is None
    ref = read_employees_ref(spark, path).collect()
    assert sorted(r.employee_id for r in ref) == [12, 13]   # Spark casts trim spaces, as in Silver


PROBE = "SELECT 1 AS ok FROM SYSIBM.SYSDUMMY1"


def test_jdbc_upsert_on_embedded_derby(spark, tmp):
    url = f"jdbc:derby:memory:db{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    J.execute(spark, url, "CREATE TABLE serving (activity_id BIGINT PRIMARY KEY, v VARCHAR(10))", props, probe_query=PROBE)
    J.execute(spark, url, "CREATE TABLE staging (activity_id BIGINT, v VARCHAR(10))", props, probe_query=PROBE)
    J.execute(spark, url, "INSERT INTO serving VALUES (1, 'old'), (2, 'keep')", props, probe_query=PROBE)
    batch = spark.createDataFrame([(1, "a", 10, 0, 1), (1, "b", 20, 0, 2), (3, "c", 5, 0, 3)],
                                  "activity_id long, v string, __source_ts_ms long, kafka_partition int, "
                                  "kafka_offset long")
    n = J.upsert(batch, url, "serving", "staging", ["activity_id"],
                 order=["__source_ts_ms", "kafka_partition", "kafka_offset"], columns=["activity_id", "v"],
                 props=props, probe_query=PROBE)
    assert n == 2
    J.upsert(batch, url, "serving", "staging", ["activity_id"],
             order=["__source_ts_ms", "kafka_partition", "kafka_offset"], columns=["activity_id", "v"],
             props=props, probe_query=PROBE)
    got = sorted((r.ACTIVITY_ID, r.V) for r in
                 spark.read.format("jdbc").option("url", url).option("dbtable", "serving")
                 .options(**props).load().collect())
    assert got == [(1, "b"), (2, "keep"), (3, "c")]


def test_empty_replay_keeps_partition(spark, tmp):
    log = os.path.join(tmp, "log")
    L.write_log_partition(spark.range(3), log, 7)
    L.write_log_partition(spark.range(0), log, 7)      # replay producing nothing
    assert read_table(spark, log).count() == 3


def test_read_reference_ordered(spark, tmp):
    from stridelake.sources.reference import read_reference
    src = os.path.join(tmp, "ref")
    spark.range(1000).selectExpr("cast((id * 7919) % 1000 as int) as employee_id", "'x' as v") \
        .repartition(7).write.parquet(src)
    got = [r.employee_id for r in read_reference(spark, "parquet", "employee_id", path=src).collect()]
    assert got == sorted(got) and len(got) == 1000
