"""Rolling activity and findings kept by deltas equal full runs after every batch."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stridelake.operators import benefits as B
from stridelake.operators import quality as Q
from stridelake.operators.rolling import RollingActivity, activity_deltas, day_sums
from stridelake.sinks.keyed import KeyedTable

SCHEMA = ("activity_id long, employee_id long, start_at timestamp, end_at timestamp, sport_type string, "
          "distance_m decimal(18,6), __op string, __source_ts_ms long, kafka_partition int, kafka_offset long, activity_date date")
START = dt.datetime(2024, 1, 1)


def versions(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for offset in range(n):
        start = START + dt.timedelta(hours=rng.randrange(24 * 20), minutes=rng.choice([0, 0, 30]))
        rows.append((rng.randrange(50), rng.choice([1, 2, 3, 3, 3, 9, None]), start, start + dt.timedelta(minutes=rng.choice([-1, 0, 30])),
                     rng.choice(["Runing", "Judo", " ", None, "Running"]),
                     rng.choice([None, Decimal("0.004"), Decimal("-2"), Decimal("1500.25")]), rng.choice("ccuud"),
                     rng.randrange(200), 0, offset, start.date()))
    return rows


def people(spark, ids):
    return spark.createDataFrame([(i, f"F{i}", f"L{i}") for i in ids], "employee_id long, first_name string, last_name string")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("seed,cuts", [(1, (50, 53)), (2, (1, 159)), (3, (80, 80))])
def test_every_split_equals_full_runs(spark, tmp, seed, cuts):
    rows = versions(seed)
    schema = spark.createDataFrame([], SCHEMA).schema
    table, rolling = KeyedTable(spark, f"{tmp}/t", schema), RollingActivity(spark, f"{tmp}/r")
    days = ["2024-12-30", "2025-01-05", "2025-01-15"]
    clocks = ["2024-01-04 00:00:00", "2024-01-09 10:30:00", "2024-01-07 00:00:00"]         # also backwards
    staff = [people(spark, ids) for ids in ([1, 3], [1, 2, 3], [2, 3, 9])]
    findings = None
    for i, part in enumerate((rows[:cuts[0]], rows[cuts[0]:cuts[1]], rows[cuts[1]:])):
        batch = spark.createDataFrame(part, SCHEMA)
        changes = table.changes(batch)
        totals = rolling.apply(changes, i, days[i])
        assert same(totals, rolling.apply(changes, i, days[i]))                            # a replay
        changed = changes.select("activity_id")
        table.upsert(batch)
        current = table.read()
        assert same(rolling.view(staff[1]), B.employee_activity_12m(staff[1], current, days[i]))
        if findings is None:
            found = Q.dq_results(current, staff[i], clocks[i])
        else:
            found = Q.refresh_findings(findings, current, staff[i], changed, Q.came_or_went(staff[i - 1], staff[i]),
                                       clocks[i - 1], clocks[i])
        found.write.parquet(f"{tmp}/f{i}")
        findings = spark.read.parquet(f"{tmp}/f{i}")
        assert same(findings.drop("detected_at"), Q.dq_results(current, staff[i], clocks[i]).drop("detected_at"))


def test_a_change_takes_back_its_old_image(spark):
    rows = [(1, 1, START, "c", Decimal("10.5")), (1, 2, START + dt.timedelta(days=1), "u", Decimal("3"))]
    types = "struct<employee_id:bigint,start_at:timestamp,__op:string,distance_m:decimal(18,6)>"
    changes = spark.createDataFrame(
        [(1, rows[0][1:], rows[1][1:]), (2, None, (5, START, "d", Decimal(1))), (3, (5, START, "d", None), (5, START, "c", None))],
        f"activity_id bigint, old {types}, new {types}")
    got = sorted((r.employee_id, str(r.day), r.n, r.metres) for r in activity_deltas(changes).collect())
    assert got == [(1, "2024-01-01", -1, Decimal("-10.500000")), (2, "2024-01-02", 1, Decimal("3.000000")),
                   (5, "2024-01-01", 1, Decimal("0.000000"))]
    log = activity_deltas(changes)
    back = log.withColumn("n", -F.col("n")).withColumn("metres", (-F.col("metres")).cast("decimal(38,6)"))
    assert day_sums(log.unionByName(back)).collect() == []


def test_views_are_as_of_a_day_and_move_forward(spark, tmp):
    rolling = RollingActivity(spark, f"{tmp}/r")
    types = "struct<employee_id:bigint,start_at:timestamp,__op:string,distance_m:decimal(18,6)>"
    none = spark.createDataFrame([], f"activity_id bigint, old {types}, new {types}")
    assert rolling.totals().collect() == []
    with pytest.raises(ValueError, match="start of a day"):
        rolling.apply(none, 0, "2025-01-05 10:00:00")
    rolling.apply(none, 0, "2025-01-05 00:00:00")
    with pytest.raises(ValueError, match="forward"):
        rolling.apply(none, 1, "2025-01-04")
    assert rolling.apply(none, 2, "2025-01-06").collect() == []


def test_unchanged_rows_are_not_judged(spark):
    rows = versions(5)
    current = spark.createDataFrame(rows, SCHEMA).dropDuplicates(["activity_id"])
    nobody = people(spark, [])
    keys = Q.rows_to_judge(current, current.limit(0).select("activity_id"), nobody, "2024-01-05", "2024-01-06")
    between = current.where("start_at > '2024-01-05' and start_at <= '2024-01-06'").select("activity_id")
    assert same(keys, between.distinct())
    moved = Q.rows_to_judge(current, current.limit(0).select("activity_id"), people(spark, [2, 9]), "2024-01-05", "2024-01-05")
    assert same(moved, current.where("employee_id in (2, 9)").select("activity_id").distinct())
