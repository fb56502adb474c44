"""Working-hours configuration queries (Q5, Q6, Q13) and the slot map that
feeds the per-user response times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_few
from ..operators.hours import (
    all_users_working_hours,
    flatten_working_hours,
    pivot_week,
    resolve_working_hours,
    weekly_slot_map,
)

# A calendar row's width, in rows of the user mapping (about 32 bytes).
CALENDAR_WIDTH = 20


def user_working_hours(mapping: DataFrame, config: DataFrame, dedup: bool = True) -> DataFrame:
    """Q5: every mapped user's configuration with its source (self, team,
    org or default), one row per configuration row."""
    return all_users_working_hours(mapping, config, dedup=dedup)


def configured_user_count(mapping: DataFrame, config: DataFrame) -> DataFrame:
    """Q5's count: one row with the number of users whose configuration was
    resolved (one per mapped user after the first-row dedup)."""
    users = user_working_hours(mapping, config).select("user_id").distinct()
    return users.agg(F.count(F.lit(1)).alias("count"))


def user_working_hours_flat(mapping: DataFrame, config: DataFrame, split_sets: bool = True) -> DataFrame:
    """The flattened (user_id, org_id, week_day, start_time, end_time) rows."""
    return flatten_working_hours(all_users_working_hours(mapping, config), split_sets=split_sets)


def working_hours_for(config: DataFrame, requests: DataFrame) -> DataFrame:
    """Q6: the configuration for each requested (user_id, org_id).

    Same priority as Q5, with the single-user lookup's matching: team rows are
    matched on the *user* id and the mapping is not consulted; week_day is
    returned as stored, and default rows carry no timezone offset."""
    req = requests.select("user_id", "org_id")
    out = resolve_working_hours(req, config, user_col="user_id", team_col="user_id", org_col="org_id")
    return out.select(
        "user_id", "org_id", "source", "week_day", "start_time", "end_time",
        F.when(F.col("source") != "default", F.col("timezone_offset")).alias("timezone_offset"),
    )


def response_hours_map(mapping: DataFrame, config: DataFrame) -> DataFrame:
    """(user_id, org_id, hours) weekly slot maps for the response-time rules: at
    most one row per mapping row, of about 600 bytes."""
    return broadcast_if_few(weekly_slot_map(user_working_hours_flat(mapping, config)), mapping, CALENDAR_WIDTH)


def weekday_pivot(working_hours: DataFrame) -> DataFrame:
    """Q13: the wide monday_start .. sunday_end form of the warehouse hours."""
    return pivot_week(working_hours)
