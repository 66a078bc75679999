"""Keyed lake table: upserts cost the touched partitions and equal a full
compaction, whatever the split into batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stridelake.operators.cdc import current_state
from stridelake.sinks.keyed import KeyedTable
from stridelake.sources.files import committed, names

SCHEMA = ("activity_id long, activity_date date, distance_m decimal(18,6), __op string, __source_ts_ms long, "
          "kafka_partition int, kafka_offset long")
COLUMNS = ["activity_id", "activity_date", "distance_m", "__op", "__source_ts_ms", "kafka_partition", "kafka_offset"]


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def change(key, date, op="c", at=1, offset=None, metres=1):
    return (key, day(date), metres, op, at, 0, at if offset is None else offset)


def frame(spark, rows):
    from decimal import Decimal

    return spark.createDataFrame([(*r[:2], None if r[2] is None else Decimal(r[2]), *r[3:]) for r in rows], SCHEMA)


def table(spark, tmp):
    return KeyedTable(spark, f"{tmp}/t", frame(spark, []).schema)


def held(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_a_batch_rewrites_only_the_dates_it_touches(spark, tmp):
    t = table(spark, tmp)
    first = [change(k, k % 90) for k in range(900)]
    assert len(t.upsert(frame(spark, first))["partitions"]) == 90
    before = t.manifest()
    reader = t.read()                                              # planned before the next upsert
    old = held(reader)
    second = [change(5, 5, "u", 2, metres=7), change(6, 8, "u", 2), change(905, 6, "c", 2)]
    done = t.upsert(frame(spark, second))
    assert done == {"version": 1, "partitions": [f"activity_date={day(n)}" for n in (5, 6, 8)], "changed": 3}
    written = [n for n in names(spark, f"{tmp}/t/data/version=1") if n.startswith("activity_date=")]
    assert len(written) == 3
    after = t.manifest()
    assert {n for n in after if after[n] != before.get(n)} == set(done["partitions"])
    assert held(t.read()) == held(current_state(frame(spark, first + second)))
    assert held(reader) == old == held(t.read(version=0))          # one version throughout
    assert {r.version for r in t.read(written=True).where(F.col("activity_id") == 6).collect()} == {1}


def test_deletes_late_changes_and_moves(spark, tmp):
    t = table(spark, tmp)
    t.upsert(frame(spark, [change(1, 0), change(2, 0), change(3, None)]))
    t.upsert(frame(spark, [change(1, 0, "d", 5), change(2, 3, "u", 5)]))
    assert [r[0] for r in held(t.read())] == [2, 3]
    assert t.upsert(frame(spark, [change(1, 0, "u", 4), change(2, 0, "u", 4)])) == {"version": 1, "partitions": [], "changed": 0}
    assert [(r[0], r[1]) for r in held(t.read())] == [(2, day(3)), (3, None)]
    assert [r[0] for r in held(t.read(deleted=True))] == [1, 2, 3]
    t.upsert(frame(spark, [change(1, 1, "c", 6), change(3, 1, "u", 6)]))       # created again; the null date is left
    assert [(r[0], r[1]) for r in held(t.read())] == [(1, day(1)), (2, day(3)), (3, day(1))]
    assert not any("HIVE_DEFAULT" in n for n in t.manifest())


def test_empty_batches_and_repeated_rows(spark, tmp):
    t = table(spark, tmp)
    assert t.upsert(frame(spark, [])) == {"version": None, "partitions": [], "changed": 0}
    assert held(t.read()) == [] and t.versions() == []
    rows = [change(1, 0), change(1, 0), (None, day(0), 1, "c", 1, 0, 1)]
    assert t.upsert(frame(spark, rows))["changed"] == 1
    assert t.upsert(frame(spark, rows))["changed"] == 0           # a replay changes nothing
    assert t.versions() == [0]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_equals_one_compaction(spark, tmp, seed):
    rng = random.Random(seed)
    log = [change(rng.randrange(40), rng.choice([None, 0, 1, 2, 3]), rng.choice("cuud"), rng.randrange(50), offset, rng.randrange(9))
           for offset in range(150)]
    rng.shuffle(log)
    t = table(spark, tmp)
    for part in (log[:60], log[60:63], log[63:]):
        t.upsert(frame(spark, part))
    assert held(t.read()) == held(current_state(frame(spark, log)))


def test_an_attempt_that_died_is_overwritten(spark, tmp):
    t = table(spark, tmp)
    t.upsert(frame(spark, [change(1, 0)]))
    frame(spark, [change(9, 0)]).write.partitionBy("activity_date").parquet(f"{tmp}/t/data/version=1")   # no manifest
    assert [r[0] for r in held(t.read())] == [1]
    t.upsert(frame(spark, [change(2, 4)]))
    assert [r[0] for r in held(t.read())] == [1, 2]


def test_expire_keeps_what_kept_versions_use(spark, tmp):
    t = table(spark, tmp)
    for n in range(4):
        t.upsert(frame(spark, [change(n, n), change(99, 50, "u", n + 1)]))
    now = held(t.read())
    gone = t.expire(keep=2)
    assert t.versions() == [2, 3] and committed(spark, f"{tmp}/t/manifest") == [2, 3]
    assert gone == [f"version={n}/activity_date={day(50)}" for n in (0, 1)]
    assert held(t.read()) == now and len(held(t.read(version=2))) == 4


def test_partition_must_be_a_date(spark, tmp):
    with pytest.raises(ValueError):
        KeyedTable(spark, tmp, frame(spark, []).schema, partition="__op")


def test_locator_reads_keys_only(spark, tmp):
    t = table(spark, tmp)
    t.upsert(frame(spark, [change(k, k % 3) for k in range(30)]))
    plan = t.changes(frame(spark, [change(1, 1, "u", 2)]))._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
