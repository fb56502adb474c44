import datetime as dt

from pyspark.sql import functions as F

from helpers import ts
from parley.functions import timecols as tc


def test_calendar_helpers_ignore_session_time_zone(spark):
    df = spark.createDataFrame([(ts("2024-01-07 23:30:00.5"),)], "t timestamp")  # a Sunday, UTC
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        row = df.select(
            tc.utc_date("t").alias("d"), tc.weekday0("t").alias("w0"), tc.weekday1("t").alias("w1"),
            tc.time_of_day_us("t").alias("tod"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert row.d == dt.date(2024, 1, 7)
    assert (row.w0, row.w1) == (0, 1)
    assert row.tod == (23 * 3600 + 30 * 60) * 1_000_000 + 500_000


def test_instant_from_ntz_is_utc(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.25' AS n")
        us = df.select(F.unix_micros(tc.instant_from_ntz("n"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert us == 1704067207250000


def test_whole_seconds_truncate(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:00:00.9"), ts("2024-01-01 10:00:02.1"))], "a timestamp, b timestamp")
    assert df.select(tc.whole_seconds_between("a", "b")).first()[0] == 1


def test_leading_int_and_rounding(spark):
    rows = spark.createDataFrame([("123",), (" 42abc",), ("-7",), ("abc",), (None,)], "x string")
    got = [r[0] for r in rows.select(tc.leading_int("x")).collect()]
    assert got == [123, 42, -7, None, None]
    vals = spark.createDataFrame([(2.5,), (-2.5,), (1.49,)], "x double")
    assert [r[0] for r in vals.select(tc.round_half_up(F.col("x"))).collect()] == [3, -2, 1]


def test_clock_parsing(spark):
    df = spark.createDataFrame([("08:30:15",), ("22:00",)], "t string")
    full = [r[0] for r in df.select(tc.clock_us("t")).collect()]
    hm = [r[0] for r in df.select(tc.clock_us("t", with_seconds=False)).collect()]
    assert full == [(8 * 3600 + 30 * 60 + 15) * 10**6, 22 * 3600 * 10**6]
    assert hm == [(8 * 3600 + 30 * 60) * 10**6, 22 * 3600 * 10**6]


def test_utc_timestamp_literal(spark):
    got = spark.range(1).select(F.unix_micros(tc.utc_timestamp_literal("2024-01-31 00:00:00"))).first()[0]
    assert got == 1706659200 * 10**6
