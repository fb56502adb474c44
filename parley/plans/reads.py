"""Message reads (Q14) and next working period / day per message (Q15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.worktime import with_next_working_periods
from ..operators.joins import lookup_join
from ..sources.readers import read_messages


def ordered_messages(
    events: DataFrame, user_id: str | None = None, run_date: str | dt.date | None = None, days: int | None = 2
) -> DataFrame:
    """Q14: all columns, ordered by user, org, chat and timestamp (a global
    range-partitioned sort: no single task receives everything)."""
    return read_messages(events, user_id, run_date, days, ordered=True)


def next_working_periods(events: DataFrame, hours_map: DataFrame) -> DataFrame:
    """Q15: for every message, the working period it falls in or the next one
    (today's slot if the message is before its end), and the next working
    day's slot, from the (user, org) weekly slot map.  Messages whose
    (user, org) has no configuration get NULLs."""
    hours = hours_map.select("user_id", "org_id", "hours", "next_offset")
    df = events.select("event_id", "user_id", "org_id", "message_timestamp")
    df = lookup_join(df, hours, ["user_id", "org_id"], ["event_id"])
    df = with_next_working_periods(df, "message_timestamp", "hours", "_period", "_day")
    return df.select(
        "event_id",
        "user_id",
        "org_id",
        "message_timestamp",
        F.col("_period.start").alias("period_start"),
        F.col("_period.end").alias("period_end"),
        F.col("_period.day").alias("period_day"),
        F.col("_day.start").alias("next_day_start"),
        F.col("_day.end").alias("next_day_end"),
        F.col("_day.day").alias("next_day"),
    )
