import datetime as dt
from decimal import Decimal

from stridelake.operators import intake as I
from stridelake.operators import master as M
from stridelake.operators import notify as N

EV = ("activity_id long, employee_id long, start_at string, end_at string, sport_type string, "
      "distance_m double, comment string, source string, __op string, kafka_offset long")


def test_notification_texts(spark):
    emp = spark.createDataFrame([(1, "Ana", "Lopez")], "employee_id int, first_name string, last_name string")
    s, e = "2024-01-01T10:00:00Z", "2024-01-01T10:30:00Z"
    ev = spark.createDataFrame([
        (1, 1, s, e, "Running", 1250.0, " Super ", "live", "c", 1),
        (2, 9, s, "2024-01-01T10:00:20Z", None, None, None, "live", "c", 2),
        (3, 1, s, e, "Judo", 5000.0, "Activité live simulée", "live", "c", 3),
        (4, 1, s, "bad", "Marche", 1150.0, "", "live", "c", 4),
        (5, 1, s, e, "Judo", None, None, "simulation", "c", 5),
        (6, 1, s, e, "Judo", None, None, "live", "d", 6),
    ], EV)
    out = {r.activity_id: r.message for r in N.notifications(ev, emp).collect()}
    assert set(out) == {1, 2, 3, 4, 6}      # live events of any operation
    assert out[1] == '🏃 Bravo Ana Lopez ! Tu viens de terminer une activité Running de 1.2 km en 30 min ! 🔥🏅\n💬 "Super"'
    assert out[2] == "🏃 Bravo Employé 9 ! Tu viens de terminer une activité sport en 1 min ! 🔥🏅"
    assert out[3] == "🏃 Bravo Ana Lopez ! Tu viens de terminer une activité Judo en 30 min ! 🔥🏅"
    assert out[4] == "🏃 Bravo Ana Lopez ! Tu viens de terminer une activité Marche de 1.1 km ! 🔥🏅"


def test_intake_split_is_a_partition(spark):
    t0, t1 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11)
    batch = spark.createDataFrame([
        (1, 1, t0, t1, "Judo", None, None),
        (2, 99, t0, t1, "Judo", None, None),                  # unknown employee
        (3, 1, t0, t0, "Judo", None, None),                   # end = start
        (4, 1, t0, t1, "Judo", Decimal("-1.00"), None),       # negative distance
        (5, 1, t0, t1, "", None, None),                       # empty sport
        (6, 99, t1, t0, "", None, None),                      # several: first in API order
        (7, None, t0, t1, "Judo", None, None),                # missing field
    ], "activity_id long, employee_id int, start_at timestamp, end_at timestamp, sport_type string, "
       "distance_m decimal(18,2), comment string")
    emp = spark.createDataFrame([(1,), (1,)], "employee_id int")
    v = I.validate_intake(batch, emp)
    acc = I.accepted(v).collect()
    rej = {r.activity_id: r.reject_reason for r in I.rejected(v).collect()}
    assert [r.activity_id for r in acc] == [1] and acc[0].source == "live"
    assert rej == {2: "employee_id inconnu", 3: "end_at must be after start_at",
                   4: "distance_m must be greater than or equal to 0",
                   5: "sport_type must have at least 1 character",
                   6: "sport_type must have at least 1 character", 7: "missing required field"}
    assert len(acc) + len(rej) == batch.count()


def test_recent_activities_clamped(spark):
    df = spark.range(500).selectExpr("id as activity_id", "1 as employee_id", "timestamp'2024-01-01' as start_at",
                                     "timestamp'2024-01-01' as end_at", "'Judo' as sport_type",
                                     "cast(null as decimal(18,2)) as distance_m", "'' as comment",
                                     "'live' as source", "timestamp'2024-01-01' as created_at")
    assert [r.activity_id for r in I.recent_activities(df, 3).collect()] == [499, 498, 497]
    assert I.recent_activities(df, 1000).count() == 100 and I.recent_activities(df, 0).count() == 1
    plan = I.recent_activities(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_master_upsert_preserves_and_dedups(spark):
    target = spark.createDataFrame([(1, "a", "t1"), (2, "b", "t1")], "employee_id int, name string, ingested_at string")
    changes = spark.createDataFrame([(2, "B", "t2", 1), (2, "BB", "t2", 2), (3, "c", "t2", 1)],
                                    "employee_id int, name string, ingested_at string, v int")
    out = M.upsert_table(target, changes, "employee_id", order=["v"], preserve=("ingested_at",))
    got = sorted((r.employee_id, r.name, r.ingested_at) for r in out.collect())
    assert got == [(1, "a", "t1"), (2, "BB", "t1"), (3, "c", "t2")]


def test_effective_sport(spark):
    emp = spark.createDataFrame([(1,), (2,), (3,), (4,)], "employee_id int")
    sp = spark.createDataFrame([(1, "Runing"), (2, ""), (3, "Judo")], "employee_id int, sport string")
    got = {r.employee_id: r.effective_sport for r in M.effective_sport(emp, sp).collect()}
    assert got == {1: "Running", 2: "Marche", 3: "Judo", 4: "Marche"}
