"""Truth table of the warehouse working-seconds rule (Column and SQL forms)."""

import pytest
from pyspark.sql import functions as F

from helpers import ts
from parley.functions.worktime import register_functions, working_seconds

H = 3600 * 10**6
NINE, SIX_PM = 9 * H, 18 * H

# (start, end, slot_start_us, slot_end_us, expected)  2024-01-01 is a Monday
CASES = [
    ("2024-01-01 10:00:00", "2024-01-01 10:05:00", NINE, SIX_PM, 300.0),       # inside
    ("2024-01-01 10:00:00.9", "2024-01-01 10:00:02.1", NINE, SIX_PM, 1.0),     # truncation
    ("2024-01-01 10:00:00", "2024-01-01 10:00:00.5", NINE, SIX_PM, 0.0),       # sub-second -> 0
    ("2024-01-01 10:05:00", "2024-01-01 10:00:00", NINE, SIX_PM, 0.0),         # reversed
    ("2024-01-01 10:00:00", "2024-01-01 10:00:00", NINE, SIX_PM, 0.0),         # equal
    ("2024-01-01 08:59:59", "2024-01-01 09:10:00", NINE, SIX_PM, 0.0),         # starts before opening
    ("2024-01-01 17:59:00", "2024-01-01 18:00:01", NINE, SIX_PM, 0.0),         # ends after closing
    ("2024-01-01 09:00:00", "2024-01-01 18:00:00", NINE, SIX_PM, 32400.0),     # both bounds inclusive
    ("2024-01-01 23:00:00", "2024-01-02 00:10:00", NINE, SIX_PM, 0.0),         # cross-day
    ("2024-01-01 10:00:00", "2024-01-01 10:05:00", 0, 0, 0.0),                 # closed 00:00-00:00
    ("2024-01-01 10:00:00", "2024-01-01 10:05:00", None, None, 0.0),           # no hours -> closed
    ("2024-01-01 10:00:00", "2024-01-01 10:05:00", None, SIX_PM, 300.0),       # only start missing
    ("2024-01-01 23:00:00", "2024-01-01 23:30:00", 22 * H, 6 * H, 0.0),        # overnight never counts
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(ts(a), ts(b), s, e, x) for a, b, s, e, x in CASES]
    return spark.createDataFrame(rows, "a timestamp, b timestamp, s long, e long, expected double")


def test_column_form(cases):
    got = cases.select(working_seconds(F.col("a"), F.col("b"), F.col("s"), F.col("e")).alias("g"), "expected")
    for row in got.collect():
        assert row.g == row.expected


def test_null_timestamps_give_zero(spark):
    df = spark.createDataFrame([(None, ts("2024-01-01 10:00:00"))], "a timestamp, b timestamp")
    assert df.select(working_seconds(F.col("a"), F.col("b"), F.lit(NINE), F.lit(SIX_PM))).first()[0] == 0.0


def test_sql_function_matches(spark, cases):
    register_functions(spark)
    cases.createOrReplaceTempView("ws_cases")
    # Put the slot on Monday (the cases' weekday) and keep every other day closed.
    got = spark.sql(
        "SELECT expected, calculate_working_seconds(a, b, coalesce(s, 0), coalesce(e, 0), "
        "0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0) AS g FROM ws_cases"
    ).collect()
    for row in got:
        assert row.g == row.expected
    # The same pair on a Tuesday uses the Tuesday slot only.
    tue = spark.sql(
        "SELECT calculate_working_seconds(TIMESTAMP'2024-01-02 10:00:00Z', TIMESTAMP'2024-01-02 10:01:00Z', "
        f"0, 0, {NINE}, {SIX_PM}, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0)"
    ).first()[0]
    assert tue == 60.0
