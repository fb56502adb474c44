"""Working-hours relations: weekday pivot (A13), per-user slot maps (J8),
configuration priority self > team > org > default (J7, A20, H4) and the
flattened configuration rows (R11).

Every per-user structure here is bounded by the week: at most seven weekday
entries per (user, org), so collecting them into a map never gathers an
unbounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import WEEKDAY_NAMES, clock_us, leading_int
from ..functions.worktime import with_calendar
from ..sources.readers import default_week_column
from .joins import broadcast_if_small

# Warehouse weekday numbering 1 = Sunday .. 7 = Saturday, and the pivot's
# column prefixes in that numbering.
_PIVOT_NAMES = {2: "monday", 3: "tuesday", 4: "wednesday", 5: "thursday", 6: "friday", 7: "saturday", 1: "sunday"}


# --------------------------------------------------------------------------
# Warehouse hours (already resolved, UTC, microseconds)
# --------------------------------------------------------------------------
def weekday_slots(working_hours: DataFrame) -> DataFrame:
    """(user_id, org_id, day_of_week, start_us, end_us), one row per weekday.
    Several rows for one weekday reduce to MAX(start), MAX(end) taken
    independently, as the weekday pivot does."""
    return working_hours.groupBy("user_id", "org_id", "day_of_week").agg(
        F.max("start_us").alias("start_us"), F.max("end_us").alias("end_us")
    )


def weekly_hours_map(working_hours: DataFrame) -> DataFrame:
    """(user_id, org_id, slots MAP<INT day_of_week, STRUCT<start_us, end_us>>):
    one row per (user, org) that has any hours row (presence = non-NULL map)."""
    slots = weekday_slots(working_hours)
    return slots.groupBy("user_id", "org_id").agg(
        F.map_from_entries(
            F.collect_list(F.struct("day_of_week", F.struct("start_us", "end_us")))
        ).alias("slots")
    )


def pivot_week(working_hours: DataFrame) -> DataFrame:
    """The wide form: monday_start, monday_end, ..., sunday_end per (user, org)."""
    wide = (
        working_hours.groupBy("user_id", "org_id")
        .pivot("day_of_week", list(_PIVOT_NAMES))
        .agg(F.max("start_us").alias("start"), F.max("end_us").alias("end"))
    )
    cols = [F.col("user_id"), F.col("org_id")]
    for dow, name in _PIVOT_NAMES.items():
        cols.append(F.col(f"{dow}_start").alias(f"{name}_start"))
        cols.append(F.col(f"{dow}_end").alias(f"{name}_end"))
    return wide.select(*cols)


# --------------------------------------------------------------------------
# Relational configuration
# --------------------------------------------------------------------------
def first_mapping_per_user(mapping: DataFrame, order_col: str = "row_order") -> DataFrame:
    """One mapping row per user: the first in read order (``order_col``), or
    the lowest (org_id, team_id) when no order column exists."""
    order = F.struct(*([order_col] if order_col in mapping.columns else []), "org_id", "team_id")
    first = mapping.groupBy("user_id").agg(F.min_by(F.struct("team_id", "org_id"), order).alias("_m"))
    return first.select("user_id", F.col("_m.team_id").alias("team_id"), F.col("_m.org_id").alias("org_id"))


def resolve_working_hours(
    requests: DataFrame,
    config: DataFrame,
    user_col: str = "user_id",
    team_col: str = "team_id",
    org_col: str = "org_id",
) -> DataFrame:
    """Priority lookup self > team > org > default for each request row.

    Matching uses the leading integer of the request ids (``parseInt``): self
    rows on ``user_col``, team rows on ``team_col`` and org rows on
    ``org_col``.  Returns the request columns plus ``source`` and one row per
    chosen configuration row (week_day, start_time, end_time,
    timezone_offset).  All keys of a request meet the configuration in one
    join, and the rows of the least priority found stay; the default calendar
    comes from a literal array, so it needs no join.
    """
    base_cols = requests.columns
    # One row per key of a request, in order of priority; the default always
    # applies.
    keys = [("self", user_col), ("team", team_col), ("org", org_col), ("default", None)]
    tries = F.array(*[
        F.struct(
            F.lit(i).alias("priority"),
            F.lit(kind).alias("source"),
            (leading_int(F.col(c)) if c else F.lit(None)).cast("long").alias("id"),
        )
        for i, (kind, c) in enumerate(keys)
    ])
    tried = requests.select("*", F.explode(tries).alias("_try")).select(
        *base_cols, F.col("_try.priority").alias("_priority"), F.col("_try.source").alias("source"), F.col("_try.id").alias("_id")
    )
    # Many requests share one team or org key; a broadcast of the (bounded)
    # configuration keeps such hot keys out of a shuffle join.
    hours = ["week_day", "start_time", "end_time", "timezone_offset"]
    cfg = broadcast_if_small(config.select(F.col("type").alias("_type"), F.col("type_id").alias("_type_id"), *hours))
    configured = tried.where(F.col("source") != "default").join(
        cfg, (F.col("source") == F.col("_type")) & (F.col("_id") == F.col("_type_id"))
    )
    defaults = tried.where(F.col("source") == "default").select("*", F.explode(default_week_column()).alias("_d"))
    defaults = defaults.select(*base_cols, "_priority", "source", *[F.col(f"_d.{c}").alias(c) for c in hours])
    found = configured.select(*base_cols, "_priority", "source", *hours).unionByName(defaults)
    # A request's rows are bounded by its configuration.
    best = F.min("_priority").over(Window.partitionBy(*base_cols))
    return found.withColumn("_best", best).where("_priority = _best").drop("_priority", "_best")


def all_users_working_hours(mapping: DataFrame, config: DataFrame, dedup: bool = True) -> DataFrame:
    """Every mapped user's configuration (one row per configuration row)."""
    users = first_mapping_per_user(mapping) if dedup else mapping.select("user_id", "team_id", "org_id")
    return resolve_working_hours(users, config)


def flatten_working_hours(resolved: DataFrame, split_sets: bool = True) -> DataFrame:
    """(user_id, org_id, week_day, start_time, end_time) with ids as strings
    and week_day lower-cased.  ``split_sets`` expands a SET value such as
    'monday,tuesday' into one row per day (a whole-string comparison would
    never match it)."""
    day = F.lower(F.col("week_day"))
    if split_sets:
        day = F.explode(F.split(day, r"\s*,\s*"))
    return resolved.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("org_id").cast("string").alias("org_id"),
        day.alias("week_day"),
        "start_time",
        "end_time",
    )


def weekly_slot_map(flat_config: DataFrame) -> DataFrame:
    """(user_id, org_id, hours MAP<INT weekday0, STRUCT<start_ms, end_ms>>,
    walk_prefix, next_offset) -- see ``functions.worktime.with_calendar``.

    Times keep hours and minutes only.  When a weekday has several rows the
    one with the lowest (start, end) wins.  A (user, org) with configuration
    rows always gets a (possibly empty) map, so "configured" and "has a slot on
    this weekday" stay distinct."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    rows = flat_config.select(
        "user_id",
        "org_id",
        (F.array_position(names, F.col("week_day")) - 1).cast("int").alias("weekday"),
        F.struct(
            (clock_us(F.col("start_time"), with_seconds=False) / 1000).cast("long").alias("start_ms"),
            (clock_us(F.col("end_time"), with_seconds=False) / 1000).cast("long").alias("end_ms"),
        ).alias("slot"),
    )
    # A slot with an unreadable clock text is no slot.
    readable = F.col("slot.start_ms").isNotNull() & F.col("slot.end_ms").isNotNull()
    per_day = rows.groupBy("user_id", "org_id", "weekday").agg(F.min(F.when(readable, F.col("slot"))).alias("slot"))
    maps = per_day.groupBy("user_id", "org_id").agg(
        F.map_from_entries(
            F.collect_list(F.when((F.col("weekday") >= 0) & F.col("slot").isNotNull(), F.struct("weekday", "slot")))
        ).alias("hours")
    )
    return with_calendar(maps, "hours")

