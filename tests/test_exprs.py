import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stridelake.functions import exprs as X


def test_duration_minutes_ties_and_sub_second(spark):
    base = dt.datetime(2024, 1, 1, 10)
    cases = [3, 9, 0, -3, -9, 29, 30, 90]
    df = spark.createDataFrame([(base, base + dt.timedelta(seconds=s)) for s in cases] +
                               [(base + dt.timedelta(microseconds=900000), base + dt.timedelta(seconds=3))],
                               "s timestamp, e timestamp")
    got = [r.d for r in df.select(X.duration_minutes_1dp("s", "e").alias("d")).collect()]
    # round half away from zero of s/60 at one decimal, on whole seconds
    assert got == [0.1, 0.2, 0.0, -0.1, -0.2, 0.5, 0.5, 1.5, 0.1]


def test_whole_minutes_notification(spark):
    base = dt.datetime(2024, 1, 1, 10)
    secs = [20, 89, 90, 150, 151, 30, -100]
    df = spark.createDataFrame([(base, base + dt.timedelta(seconds=s)) for s in secs], "s timestamp, e timestamp")
    got = [r.m for r in df.select(X.whole_minutes_half_even("s", "e").alias("m")).collect()]
    assert got == [max(1, round(s / 60)) for s in secs]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(min_value=-10_000_000, max_value=10_000_000), min_size=1, max_size=50))
def test_km_text_matches_python(spark, cents):
    vals = [Decimal(c) / 100 for c in cents] + [Decimal(50 * c) for c in cents]
    df = spark.createDataFrame([(v,) for v in vals], "m decimal(18,2)")
    got = [r.t for r in df.select(X.km_text_1dp("m").alias("t")).collect()]
    assert got == [f"{float(v) / 1000:.1f}" for v in vals]


def test_text_cleaning(spark):
    df = spark.createDataFrame([(" 29.0 ",), ("12,7",), ("",), (" ",), ("n/a",), ("\t5\n",), (None,)], "t string")
    got = [(r.i, r.d, r.b) for r in df.select(X.text_to_int("t").alias("i"), X.text_to_decimal("t").alias("d"),
                                                 X.blank_to_null("t").alias("b")).collect()]
    assert got == [(29, Decimal("29.00"), "29.0"), (12, Decimal("12.70"), "12,7"), (None, None, None),
                   (None, None, None), (None, None, "n/a"), (5, Decimal("5.00"), "5"), (None, None, None)]


def test_sport_rules_and_blank(spark):
    df = spark.createDataFrame([("Runing",), ("",), (None,), ("Judo",), ("\t",), ("  ",)], "s string")
    got = [(r.n, r.b) for r in df.select(X.normalise_sport(X.default_sport("s")).alias("n"),
                                           X.is_blank_sql("s").alias("b")).collect()]
    assert got == [("Running", False), ("Marche", True), ("Marche", True), ("Judo", False),
                   ("\t", False), ("  ", True)]


def test_km_and_percent_rounding(spark):
    df = spark.createDataFrame([(15004,), (15005,), (-15005,), (None,)], "m long")
    got = [r.k for r in df.select(X.metres_to_km_2dp("m").alias("k")).collect()]
    assert got == [Decimal("15.00"), Decimal("15.01"), Decimal("-15.01"), None]
    p = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (1, 400)], "n long, t long")
    got = [r.p for r in p.select(X.percent_1dp("n", "t").alias("p")).collect()]
    assert got == [Decimal("12.5"), Decimal("33.3"), Decimal("66.7"), Decimal("0.3")]
    z = spark.range(1).select(X.python_float_text(F.lit(Decimal("15.50"))).alias("a"),
                              X.python_float_text(F.lit(Decimal("20.00"))).alias("b")).collect()[0]
    assert (z.a, z.b) == ("15.5", "20.0")


def test_iso_timestamp_parsing(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01T12:00:00+02:00",),
                                ("2024-01-01T10:00:00.123456Z",), ("not a date",), (None,)], "t string")
    got = [r.ts for r in df.select(X.parse_iso_ts("t").cast("timestamp_ntz").alias("ts")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10),
                   dt.datetime(2024, 1, 1, 10, 0, 0, 123456), None, None]


def test_ids_are_exact_to_the_last_bit(spark):
    from stridelake.functions.exprs import text_to_int
    cells = ["9007199254740993", "9223372036854775807", "29.0", " 12,7 ", "-3.9", "12d", "1e3", "", "x", "9223372036854775808"]
    got = [r.n for r in spark.createDataFrame([(c,) for c in cells], "c string")
           .select(text_to_int("c", "long").alias("n")).collect()]
    assert got == [9007199254740993, 9223372036854775807, 29, 12, -3, None, 1000, None, None, None]
