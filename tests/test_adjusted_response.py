"""Message-level working-hours rule: every case of the decision tree.

Calendar (weekday 0 = Sunday): Monday 09-18, Tuesday 09-17, Thursday 10-12,
Friday 22-06 (overnight), Sunday 09-09 (equal ends: a 24 h window, length 0
in the walk).  2024-01-01 is a Monday."""

import pytest

from helpers import slot_map, ts
from parley.functions.worktime import with_adjusted_response_ms, with_calendar

HOUR = 3_600_000
CAL = {1: ("09:00", "18:00"), 2: ("09:00", "17:00"), 4: ("10:00", "12:00"), 5: ("22:00", "06:00"), 0: ("09:00", "09:00")}

CASES = [
    # case, incoming, outgoing, expected ms
    ("K1 no slot either day", "2024-01-06 10:00:00", "2024-01-06 11:00:00", None),
    ("K2 no incoming slot, next day", "2024-01-03 10:00:00", "2024-01-04 11:00:00", 1 * HOUR),
    ("K2 walk over a week end", "2024-01-06 10:00:00", "2024-01-09 10:00:00", 9 * HOUR + 1 * HOUR),
    ("K3 no incoming slot, out after closing", "2024-01-03 10:00:00", "2024-01-04 13:00:00", None),
    ("K4 inside", "2024-01-01 10:00:00", "2024-01-01 11:00:00", 1 * HOUR),
    ("K4 overnight slot", "2024-01-05 23:00:00", "2024-01-06 05:00:00", 6 * HOUR),
    ("K4 24h window from equal ends", "2024-01-07 10:00:00", "2024-01-07 20:00:00", 10 * HOUR),
    ("K5 next working day", "2024-01-01 17:00:00", "2024-01-02 10:00:00", 2 * HOUR),
    ("K5 with days between", "2024-01-01 17:00:00", "2024-01-04 11:00:00", 1 * HOUR + 8 * HOUR + 1 * HOUR),
    ("K6 out after closing of out day", "2024-01-01 17:00:00", "2024-01-02 18:00:00", None),
    ("K7 no slot on out day", "2024-01-01 17:00:00", "2024-01-03 10:00:00", None),
    ("K8 same day, reply after closing", "2024-01-01 10:00:00", "2024-01-01 19:00:00", None),
    ("K8 before opening, reply after closing", "2024-01-01 08:00:00", "2024-01-01 19:00:00", None),
    ("K9 same day, message before opening", "2024-01-01 08:00:00", "2024-01-01 10:00:00", 0),
    ("K9 after closing, answered two days later", "2024-01-02 18:00:00", "2024-01-04 10:30:00", HOUR // 2),
    ("K10 after closing, no slot on out day", "2024-01-02 18:00:00", "2024-01-03 10:00:00", None),
    ("K11 same weekday a week later", "2024-01-01 17:00:00", "2024-01-08 10:00:00", 1 * HOUR),
    ("ms precision", "2024-01-01 10:00:00.0009", "2024-01-01 10:00:01.2345", 1234),
]


@pytest.fixture(scope="module")
def result(spark):
    rows = [(name, ts(a), ts(b), exp) for name, a, b, exp in CASES]
    df = spark.createDataFrame(rows, "name string, i timestamp, o timestamp, expected long")
    df = with_calendar(df.withColumn("hours", slot_map(CAL)), "hours")
    return {r.name: (r.expected, r.adjusted_ms) for r in with_adjusted_response_ms(df, "i", "o").collect()}


@pytest.mark.parametrize("name", [c[0] for c in CASES])
def test_case(result, name):
    expected, got = result[name]
    assert got == expected, name


def test_calendar_arrays(spark):
    df = with_calendar(spark.range(1).select(slot_map(CAL).alias("hours")), "hours").first()
    # lengths by weekday: sun 0, mon 9h, tue 8h, wed 0, thu 2h, fri 8h (overnight), sat 0
    lens = [0, 9, 8, 0, 2, 8, 0]
    expected_prefix = [sum(lens[k % 7] for k in range(j)) * HOUR for j in range(15)]
    assert df.walk_prefix == expected_prefix
    assert df.next_offset == [1, 1, 2, 1, 1, 2, 1]
    empty = with_calendar(spark.range(1).select(slot_map({}).alias("hours")), "hours").first()
    assert empty.next_offset == [None] * 7


EXACT_CASES = [
    # One Monday later: a day's rest, the six days between (8 + 2 + 8 hours), and an hour.
    ("same weekday a week later", "2024-01-01 17:00:00", "2024-01-08 10:00:00", (1 + 18 + 1) * HOUR),
    ("ten days later", "2024-01-01 17:00:00", "2024-01-11 11:00:00", (1 + 18 + 9 + 8 + 1) * HOUR),
    ("three weeks later", "2024-01-02 16:00:00", "2024-01-23 10:00:00", (1 + 2 * 27 + 2 + 8 + 9 + 1) * HOUR),
    ("no incoming slot, a week later", "2024-01-03 10:00:00", "2024-01-11 11:00:00", (2 + 8 + 9 + 8 + 1) * HOUR),
    ("after closing, the same weekday a week later", "2024-01-01 19:00:00", "2024-01-08 10:00:00", (18 + 1) * HOUR),
    ("closed on the day of the reply", "2024-01-01 17:00:00", "2024-01-10 10:00:00", None),
]


@pytest.mark.parametrize("case", EXACT_CASES, ids=[c[0] for c in EXACT_CASES])
def test_dates_instead_of_weekdays(spark, case):
    name, a, b, expected = case
    df = with_calendar(spark.createDataFrame([(ts(a), ts(b))], "i timestamp, o timestamp").withColumn("hours", slot_map(CAL)), "hours")
    assert with_adjusted_response_ms(df, "i", "o", calendar_exact=True).first().adjusted_ms == expected


def test_within_a_week_both_settings_agree(spark):
    rows = [(n, ts(a), ts(b)) for n, a, b, _ in CASES if "week later" not in n]
    df = with_calendar(spark.createDataFrame(rows, "n string, i timestamp, o timestamp").withColumn("hours", slot_map(CAL)), "hours")
    df = with_adjusted_response_ms(df, "i", "o")
    df = with_adjusted_response_ms(df, "i", "o", name="exact", calendar_exact=True)
    assert df.where("NOT (adjusted_ms <=> exact)").count() == 0
