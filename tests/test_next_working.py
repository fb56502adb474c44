import pytest

from helpers import slot_map, ts
from parley.functions.worktime import with_calendar, with_next_working_periods

CAL = {1: ("09:00", "18:00"), 4: ("10:00", "12:00"), 5: ("22:00", "06:00")}

CASES = [
    # t, period (start, end, day), next day (start, end, day)
    ("2024-01-01 08:00:00", ("2024-01-01 09:00:00", "2024-01-01 18:00:00", "monday"),
     ("2024-01-04 10:00:00", "2024-01-04 12:00:00", "thursday")),
    ("2024-01-01 19:00:00", ("2024-01-04 10:00:00", "2024-01-04 12:00:00", "thursday"),
     ("2024-01-04 10:00:00", "2024-01-04 12:00:00", "thursday")),
    ("2024-01-05 23:00:00", ("2024-01-05 22:00:00", "2024-01-06 06:00:00", "friday"),
     ("2024-01-08 09:00:00", "2024-01-08 18:00:00", "monday")),
    ("2024-01-04 13:00:00", ("2024-01-05 22:00:00", "2024-01-06 06:00:00", "friday"),
     ("2024-01-05 22:00:00", "2024-01-06 06:00:00", "friday")),
]


def _run(spark, cal, t):
    df = spark.createDataFrame([(ts(t),)], "t timestamp").withColumn("hours", slot_map(cal))
    return with_next_working_periods(with_calendar(df, "hours"), "t").first()


def _as_tuple(p):
    if p is None:
        return None
    return (p.start.strftime("%Y-%m-%d %H:%M:%S"), p.end.strftime("%Y-%m-%d %H:%M:%S"), p.day)


@pytest.mark.parametrize("t,period,day", CASES)
def test_next_periods(spark, t, period, day):
    row = _run(spark, CAL, t)
    assert _as_tuple(row.next_period) == period
    assert _as_tuple(row.next_day) == day


def test_single_slot_day_wraps_a_week(spark):
    row = _run(spark, {1: ("09:00", "18:00")}, "2024-01-01 19:00:00")
    assert _as_tuple(row.next_period) == ("2024-01-08 09:00:00", "2024-01-08 18:00:00", "monday")


def test_no_slots(spark):
    row = _run(spark, {}, "2024-01-01 19:00:00")
    assert row.next_period is None and row.next_day is None
