"""As-of enrichment, date series, snapshot differences and schema drift."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stridelake.operators import asof as AO
from stridelake.operators import benefits as B
from stridelake.operators import cdc as CDC
from stridelake.operators import drift as D
from stridelake.operators import series as SE
from stridelake.operators import snapshots as SN
from stridelake.sources.files import committed
from stridelake.sources.reference import PinnedReferences, key_ranges
from stridelake.sinks.lake import publish_reference


def t(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=str)


# --- as-of ------------------------------------------------------------------------

def test_history_of_snapshots(spark):
    snaps = spark.createDataFrame(
        [(1, "a", t(0)), (1, "a", t(5)), (1, "b", t(9)), (2, "x", t(0)), (2, "x", t(9)), (3, None, t(5)), (3, "z", t(5)),
         (4, None, t(9))], "k long, unit string, stamp timestamp")
    assert rows(AO.history(snaps, "k")) == sorted([
        (1, "a", t(0), t(9)), (1, "b", t(9), None), (2, "x", t(0), t(5)), (2, "x", t(9), None), (3, "z", t(5), t(9)),
        (4, None, t(9), None)], key=str)


def test_in_force_like_a_scan_of_the_versions(spark):
    rng = random.Random(1)
    snaps = [(k, rng.choice("abc"), t(s)) for s in (0, 3, 4, 70, 200) for k in range(6) if rng.random() < 0.8]
    changes = [(i, rng.choice([0, 0, 0, 1, 2, 5, 9, None]), rng.choice([None, t(rng.randrange(-20, 260), rng.randrange(24)), t(4)]))
               for i in range(300)]
    versions = AO.history(spark.createDataFrame(snaps, "k long, unit string, stamp timestamp"), "k")
    changed = spark.createDataFrame(changes, "id long, k long, at timestamp")
    stamps = sorted({s for _, _, s in snaps})

    def unit(k, at):
        now = [s for s in stamps if at is not None and s <= at]
        return next((u for kk, u, s in snaps if now and kk == k and s == now[-1]), None)

    want = sorted(((i, k, at, unit(k, at)) for i, k, at in changes), key=str)
    for days in (1, 31, 1000):
        got = AO.in_force(changed, versions, "k", "at", bucket_days=days)
        assert got.columns == ["id", "k", "at", "unit", "reference_from"] and rows(got, "id", "k", "at", "unit") == want
    assert AO.in_force(changed.limit(0), versions, "k", "at").collect() == []
    assert rows(AO.in_force(changed, versions.limit(0), "k", "at"), "unit") == [(None,)] * 300


def test_a_hot_employee_is_split(spark):
    """One employee holds all changes: no task of the join reads most of them."""
    changed = spark.range(40_000).select(F.lit(7).cast("long").alias("k"), F.timestamp_seconds(1704067200 + F.col("id") * 300).alias("at"))
    snaps = spark.createDataFrame([(7, "a", t(0)), (7, "b", t(60))], "k long, unit string, stamp timestamp")
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for c in kept:
        spark.conf.set(c, "-1")
    try:
        joined = AO.in_force(changed, AO.history(snaps, "k"), "k", "at", bucket_days=7)
        per_bucket = joined.groupBy(F.floor(F.unix_seconds("at") / (7 * 86400)).alias("b")).count().agg(F.max("count")).first()[0]
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert per_bucket <= 7 * 288 and "_at_bucket" in plan and "SortMergeJoin" in plan and "Window" not in plan.split("SortMergeJoin")[0]


def test_a_replayed_batch_reads_the_version_it_read(spark, tmp):
    def publish(unit, stamp):
        publish_reference(spark.createDataFrame([(1, unit)], "employee_id int, unit string"), f"{tmp}/a/e", f"{tmp}/cur", stamp)

    publish("old", "20240101T000000000000Z")
    pinned = PinnedReferences(f"{tmp}/log", {"employees": f"{tmp}/cur", "sports": f"{tmp}/none.csv"})
    first = pinned.files(spark, 0)
    assert first["sports"] == f"{tmp}/none.csv"                       # no versions: the path itself
    publish("new", "20240102T000000000000Z")
    assert pinned.files(spark, 0) == first and pinned.files(spark, 1)["employees"] != first["employees"]
    assert PinnedReferences(f"{tmp}/log", {}).files(spark, 0) == first and committed(spark, f"{tmp}/log") == [0, 1]


# --- date series -----------------------------------------------------------------------

def _people(spark, n=40):
    return spark.createDataFrame(
        [(i, f"F{i}", f"L{i}", None if i == 3 else 1000 + i, ["Marche/running", "Vélo/Trottinette/Autres", "bus", None][i % 4]) for i in range(n)],
        "employee_id long, first_name string, last_name string, annual_gross_salary int, commute_mode string"
    ).withColumn("annual_gross_salary", F.col("annual_gross_salary").cast("decimal(12,2)"))


def test_a_series_equals_single_runs(spark):
    rng = random.Random(5)
    activities = spark.createDataFrame(
        [(None if i % 50 == 0 else i, rng.choice([1, 1, 1, 2, 5, 9, 77, None]), None if i % 40 == 0 else t(rng.randrange(-800, 400), rng.randrange(24)), 1.0)
         for i in range(900)], "activity_id long, employee_id long, start_at timestamp, distance_m double")
    people = _people(spark)
    commute = spark.createDataFrame([(i, "VALID" if i % 2 else "ANOMALY") for i in range(20)], "employee_id long, validation_status string")
    params = spark.createDataFrame(
        [("min_annual_activities", 15, dt.date(2023, 1, 1), None), ("min_annual_activities", 9, dt.date(2022, 1, 1), dt.date(2023, 6, 1)),
         ("wellness_days", 5, dt.date(2023, 2, 1), None), ("bonus_rate", 1, dt.date(2023, 3, 1), dt.date(2024, 1, 1)), ("bonus_rate", 2, dt.date(2024, 1, 1), None)],
        "parameter_name string, parameter_value int, valid_from date, valid_to date").withColumn("parameter_value", F.col("parameter_value").cast("decimal(18,6)"))
    dates = [str((dt.date(2022, 11, 1) + dt.timedelta(days=31 * k)).replace(day=1) - dt.timedelta(days=1)) for k in range(1, 25)]
    series = SE.eligibility_series(people, activities, commute, params, [*reversed(dates), dates[0]])
    plan = series._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD [activity_id") == 1                                     # one scan of activities
    found = series.collect()
    assert len(found) == 24 * 40
    columns = [c for c in series.columns if c != "as_of"]
    for d in dates[::5] + dates[-1:]:
        single = B.benefit_eligibility(people, activities, commute, params, as_of=d, params_as_of=d)
        got = sorted((tuple(r[c] for c in columns) for r in found if str(r.as_of) == d), key=str)
        assert got == rows(single, *columns)


def test_series_without_activities(spark):
    people = _people(spark, 3)
    none = spark.createDataFrame([], "activity_id long, employee_id long, start_at timestamp, distance_m double")
    counts = SE.activity_counts_series(people, none, ["2024-01-31", "2024-02-29"])
    assert rows(counts, "employee_id", "place", "activity_count_12m") == [(e, p, 0) for e in range(3) for p in range(2)]


def test_employees_are_dealt_and_sorted_as_one_row_each(spark):
    """Their rows are copied to the dates after the last shuffle, sort and
    aggregate, and no scan task sorts the rows that it reads."""
    none = spark.createDataFrame([], "activity_id long, employee_id long, start_at timestamp, distance_m double")
    counts = SE.activity_counts_series(_people(spark, 3), none, ["2024-01-31", "2024-02-29"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1 and "Window" not in plan
    above, below = plan.split("Generate")
    assert not any(x in above for x in ("Exchange", "Sort", "Aggregate"))
    assert below.index("partial_max(_person") < below.index("Sort [employee_id") < below.index("Exchange hashpartitioning(employee_id")


def test_series_with_repeated_and_null_keys(spark):
    """Rows of a key are one employee, the greatest of them; those without one too."""
    people = spark.createDataFrame([(1, "a", 5), (1, "b", None), (1, "a", 9), (None, "x", 1), (None, None, 2), (2, None, None)],
                                   "employee_id long, first_name string, level int")
    activities = spark.createDataFrame(
        [(1, 1, t(-200)), (2, 1, t(-200)), (3, None, t(0)), (4, None, t(-200)), (None, 2, t(0)), (5, 2, None), (6, 2, t(-900)), (7, 8, t(0))],
        "activity_id long, employee_id long, start_at timestamp")
    counts = SE.activity_counts_series(people, activities, ["2024-01-01", "2024-12-31"])
    assert rows(counts) == sorted([(1, "b", None, 0, 2), (1, "b", None, 1, 0), (None, "x", 1, 0, 2), (None, "x", 1, 1, 1),
                                   (2, None, None, 0, 0), (2, None, None, 1, 0)], key=str)


# --- snapshot differences ----------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2, 3])
def test_changes_turn_one_version_into_the_other(spark, seed):
    rng = random.Random(seed)
    schema = "id long, a string, b string, n int"

    def version():
        return [(k, rng.choice(["x", None]), rng.choice(["x", None]), rng.choice([1, 2])) for k in range(60) if rng.random() < 0.7]

    old, new = version(), version()
    new += [r for r in old[:10] if r[0] not in {k[0] for k in new}]
    changes = SN.diff_snapshots(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), "id")
    assert rows(SN.apply_changes(spark.createDataFrame(old, schema), changes, "id")) == sorted(new, key=str)
    before, after = {r[0]: r for r in old}, {r[0]: r for r in new}
    want = [("c", *r) for k, r in after.items() if k not in before] + [("d", *r) for k, r in before.items() if k not in after] \
        + [("u", *r) for k, r in after.items() if k in before and before[k] != r]
    assert rows(changes) == sorted(want, key=str)


def test_repeated_and_null_keys_and_cascades(spark):
    schema = "id long, a string"
    old = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "q"), (4, "k"), (4, "l")], schema)
    new = spark.createDataFrame([(1, "x"), (3, "z"), (3, "zz"), (4, "l"), (4, "k"), (None, "r")], schema)
    changes = SN.diff_snapshots(old, new, "id")
    assert rows(changes) == [("c", 3, "zz"), ("d", 2, "y")]
    child = spark.createDataFrame([(10, 2), (11, 2), (12, 1), (13, None)], "child long, id long")
    assert rows(SN.cascade_deletes(changes, child, "id")) == [("d", 10, 2), ("d", 11, 2)]
    assert SN.diff_snapshots(old.limit(0), old.limit(0), "id").collect() == []


def test_unchanged_rows_are_not_shuffled_whole(spark):
    wide = spark.range(100).select("id", *[F.repeat(F.lit("x"), 50).alias(f"c{i}") for i in range(5)])
    plan = SN.diff_snapshots(wide, wide.withColumn("c0", F.lit("y")), "id")._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "FullOuter" in line:
            assert "c1" not in line


# --- drift ------------------------------------------------------------------------------------

MESSAGES = [
    '{"payload":{"activity_id":1,"distance_m":2.5,"extra":{"a":1,"b":{"c":[1,"x"]}},"none":null}}',
    '{"activity_id":2,"extra":"text","flag":true}', '{"payload":{"activity_id":3}}', '{"payload":null}', "{not json", "[1]", "7", None,
    '{"payload":{"activity_id":4,"extra":{"a":"1"},"big":12345678901234567890123}}']


def _decoded(spark, keep):
    raw = spark.createDataFrame([(m, 0, i, None) for i, m in enumerate(MESSAGES)], "value string, partition int, offset long, timestamp timestamp")
    return CDC.decode_cdc(raw, ingested_at="2024-01-01 00:00:00", keep_unknown=keep)


def test_unknown_fields_stay_beside_the_typed_columns(spark):
    plain, kept = _decoded(spark, False), _decoded(spark, True)
    assert kept.columns == [*plain.columns, "unknown_fields"]
    assert rows(kept.drop("unknown_fields")) == rows(plain)
    texts = {r.kafka_offset: r.unknown_fields for r in kept.collect()}
    assert texts[0] == '{"extra":{"a":1,"b":{"c":[1,"x"]}},"none":null}' and texts[1] == '{"extra":"text","flag":true}'
    assert all(texts[i] is None for i in range(2, 8))


def test_unknown_fields_survive_bronze(spark, tmp):
    kept = _decoded(spark, True)
    kept.write.parquet(f"{tmp}/bronze")
    assert rows(spark.read.parquet(f"{tmp}/bronze")) == rows(kept)


def test_drift_report(spark):
    got = rows(D.drift_report(_decoded(spark, True)))
    assert got == sorted([
        ("extra", "OBJECT", 2, 0, 8), ("extra", "STRING", 1, 1, 1), ("extra.a", "BIGINT", 1, 0, 0), ("extra.a", "STRING", 1, 8, 8),
        ("extra.b", "OBJECT", 1, 0, 0), ("extra.b.c", "ARRAY", 1, 0, 0), ("none", "VOID", 1, 0, 0), ("flag", "BOOLEAN", 1, 1, 1),
        ("big", "DECIMAL", 1, 8, 8)], key=str)
    assert {r.path for r in D.drift_report(_decoded(spark, True), depth=1).collect()} == {"extra", "none", "flag", "big"}
    assert D.drift_report(_decoded(spark, True).limit(0)).collect() == []


# --- key ranges ---------------------------------------------------------------------------------

@pytest.mark.parametrize("keys", [list(range(1000)), [1] * 900 + list(range(100)), [None] * 50 + [5], [], [2**40 + 7 * i * i for i in range(500)]])
def test_key_ranges_take_every_row_once(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "employee_id long")
    conditions = key_ranges(df, "employee_id", 8)
    counts = [df.where(c).count() for c in conditions]
    assert sum(counts) == len(keys) and len(conditions) <= 8
    if len(set(keys)) == len(keys) > 100:
        assert max(counts) <= 2 * len(keys) / 8                       # even ranges of uneven keys
