"""Working-time rules as pure Column expressions (no Python in the row path).

Two families exist, and they intentionally disagree (they come from two
different parts of the original system):

* ``working_seconds`` -- the warehouse rule used by the lifetime and daily
  summaries: all-or-nothing, whole seconds, same UTC day only.
* ``adjusted_response_ms`` -- the message-level rule used by the per-user
  response times: a decision tree over the weekday slots of the incoming and
  outgoing day, with a walk over the weekdays in between.

Weekly slot maps used by the message-level rules have the shape
``MAP<INT, STRUCT<start_ms: BIGINT, end_ms: BIGINT>>`` keyed by weekday
0 = Sunday .. 6 = Saturday, times in milliseconds since midnight UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .timecols import (
    MS_PER_DAY,
    US_PER_DAY,
    epoch_ms,
    time_of_day_us,
    utc_unix_date,
    weekday_name,
    whole_seconds_between,
)


# --------------------------------------------------------------------------
# Warehouse rule (H1, H3)
# --------------------------------------------------------------------------
def working_seconds(start: Column, end: Column, slot_start_us: Column, slot_end_us: Column) -> Column:
    """Seconds of a reply counted as working time, as DOUBLE.

    Positive only when the pair lies on one UTC date, the weekday slot is open
    (a missing slot defaults to 00:00-00:00 = closed) and both ends fall inside
    the slot (inclusive); then it is the whole seconds between them.  Any NULL
    input, a reversed pair, a cross-day pair or a partial overlap gives 0.
    """
    s = F.coalesce(slot_start_us, F.lit(0))
    e = F.coalesce(slot_end_us, F.lit(0))
    inside = (
        (start < end)
        & (utc_unix_date(start) == utc_unix_date(end))
        & ~((s == 0) & (e == 0))
        & (time_of_day_us(start) >= s)
        & (time_of_day_us(end) <= e)
    )
    return F.when(inside, whole_seconds_between(start, end).cast("double")).otherwise(F.lit(0.0))


# The 16-argument SQL form (two timestamps + start/end for Monday..Sunday),
# registered as a temporary SQL function.  Parameter order is fixed by the
# original function signature: monday first, sunday last.
_WEEK_ORDER = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def register_functions(spark: SparkSession) -> None:
    """Register ``calculate_working_seconds(start, end, mon_start, mon_end, ...,
    sun_start, sun_end)`` (times of day as BIGINT microseconds) as a temporary
    SQL function.  Catalyst inlines it, so it costs the same as the Column
    form."""
    params = ", ".join(
        ["start_ts TIMESTAMP", "end_ts TIMESTAMP"]
        + [f"{d}_{p} BIGINT" for d in _WEEK_ORDER for p in ("start", "end")]
    )
    # weekday 1 = Sunday .. 7 = Saturday
    dow = f"(pmod((unix_micros(start_ts) - pmod(unix_micros(start_ts), {US_PER_DAY})) div {US_PER_DAY} + 4, 7) + 1)"
    slot_start = "CASE " + " ".join(
        f"WHEN {dow} = {i} THEN {d}_start" for i, d in _dow_pairs()
    ) + " END"
    slot_end = "CASE " + " ".join(f"WHEN {dow} = {i} THEN {d}_end" for i, d in _dow_pairs()) + " END"
    tod_s = f"pmod(unix_micros(start_ts), {US_PER_DAY})"
    tod_e = f"pmod(unix_micros(end_ts), {US_PER_DAY})"
    day_s = f"((unix_micros(start_ts) - {tod_s}) div {US_PER_DAY})"
    day_e = f"((unix_micros(end_ts) - {tod_e}) div {US_PER_DAY})"
    # One positive predicate with an ELSE 0: NULL anywhere yields 0.
    body = (
        f"CASE WHEN start_ts < end_ts AND {day_s} = {day_e} "
        f"AND {slot_start} IS NOT NULL AND {slot_end} IS NOT NULL "
        f"AND NOT ({slot_start} = 0 AND {slot_end} = 0) "
        f"AND {tod_s} >= {slot_start} AND {tod_e} <= {slot_end} "
        f"THEN CAST(timestampdiff(SECOND, start_ts, end_ts) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION calculate_working_seconds({params}) "
        f"RETURNS DOUBLE RETURN {body}"
    )


def _dow_pairs() -> list[tuple[int, str]]:
    # 1 = Sunday, 2 = Monday, ..., 7 = Saturday
    return [(1, "sunday")] + [(i + 2, d) for i, d in enumerate(_WEEK_ORDER[:-1])]


# --------------------------------------------------------------------------
# Message-level rule (H5 - H7)
# --------------------------------------------------------------------------
def _placed(day_start_ms: Column, slot: Column) -> tuple[Column, Column]:
    """Slot placed on a date; an end at or before the start means the slot
    runs past midnight, so the end moves to the next day (equal start and
    end therefore give a 24 h window)."""
    start = day_start_ms + slot["start_ms"]
    end0 = day_start_ms + slot["end_ms"]
    return start, F.when(end0 <= start, end0 + MS_PER_DAY).otherwise(end0)


def slot_length_ms(slot: Column) -> Column:
    """Length of a weekday slot used in the weekly walk: end - start, plus a
    day when negative (overnight); equal ends give 0."""
    length = slot["end_ms"] - slot["start_ms"]
    return F.when(length < 0, length + MS_PER_DAY).otherwise(length)


def with_calendar(df: DataFrame, hours: str = "hours") -> DataFrame:
    """Add the per-calendar lookup arrays used by the message-level rules,
    derived once from the weekly slot map ``hours`` (so per-message work is
    two array reads instead of a walk over weekdays):

    * ``walk_prefix`` ARRAY<BIGINT>[15]: prefix sums of slot lengths over two
      weeks, entry j = sum of lengths of weekdays 0 .. j-1 (mod 7); weekdays
      without a slot add 0.
    * ``next_offset`` ARRAY<INT>[7]: for weekday d, the number of days (1..7)
      to the next weekday that has a slot; NULL when the map has none.
    """
    h = F.col(hours)
    zero = F.lit(0).cast("long")
    lens = [f"_len{k}" for k in range(7)]
    has = [f"_has{k}" for k in range(7)]
    d = df.select(
        "*",
        *[F.coalesce(slot_length_ms(h[F.lit(k)]), zero).alias(lens[k]) for k in range(7)],
        *[h[F.lit(k)].isNotNull().alias(has[k]) for k in range(7)],
    )
    prefix = []
    acc = zero
    for j in range(15):
        prefix.append(acc)
        acc = acc + F.col(lens[j % 7])
    offsets = [
        F.coalesce(*[F.when(F.col(has[(day + i) % 7]), F.lit(i)) for i in range(1, 8)]) for day in range(7)
    ]
    return d.select(
        "*", F.array(*prefix).alias("walk_prefix"), F.array(*offsets).alias("next_offset")
    ).drop(*lens, *has)


def _days_between(walk_prefix: Column, d_in: Column, n: Column) -> Column:
    """Sum of slot lengths of the weekdays strictly between d_in and
    d_in + n (n >= 1): prefix[d_in + n] - prefix[d_in + 1]."""
    return F.get(walk_prefix, d_in + n) - F.get(walk_prefix, d_in + 1)


def _dates_between(walk_prefix: Column, d_in: Column, days: Column) -> Column:
    """Sum of slot lengths of the dates strictly between a date of weekday
    d_in and the date ``days`` (>= 1) later: whole weeks times the weekly total,
    and the days that are left over by prefix sums."""
    rest = F.pmod(days - 1, F.lit(7)).cast("int")
    weeks = ((days - 1 - rest) / 7).cast("long")
    start = d_in + 1
    return weeks * F.get(walk_prefix, F.lit(7)) + F.get(walk_prefix, start + rest) - F.get(walk_prefix, start)


def with_adjusted_response_ms(
    df: DataFrame,
    incoming: str,
    outgoing: str,
    hours: str = "hours",
    name: str = "adjusted_ms",
    walk_prefix: str = "walk_prefix",
    calendar_exact: bool = False,
) -> DataFrame:
    """Add ``name``: the working-hours adjusted reply time in milliseconds, NULL
    when the pair is filtered out.  ``hours`` names a weekly slot map column
    (see module doc) and ``walk_prefix`` its prefix array (``with_calendar``).

    Cases, evaluated in order (ws/we = the incoming weekday's slot placed on
    the incoming date, os/oe = the outgoing weekday's slot on the outgoing
    date, n = weekdays from incoming to outgoing, mod 7):

    1. no slot either day                        -> NULL
    2. no incoming slot, out in [os, oe]         -> walk
    3. no incoming slot                          -> NULL
    4. in >= ws and out <= we                    -> raw
    5. in in [ws, we], other weekday, out in [os, oe]
                                                 -> (we - in) + full days between + (out - os)
    6. in in [ws, we], other weekday             -> NULL
    7. outgoing slot exists, out outside it      -> NULL
    8. in outside [ws, we], out in [os, oe]      -> walk
    9. in outside [ws, we]                       -> NULL
    10. out > we                                 -> we - in
    11. otherwise                                -> NULL

    walk = full days strictly between + (out - os) when the weekdays differ,
    0 on the same weekday (so a message before opening answered inside the
    slot on the same day counts 0).  Walk and case 5 are floored at 0.

    Weekdays alone decide by default (parity): a reply a week or more later
    walks like one within the week, and one on the same weekday of another
    week counts as the same day.  ``calendar_exact`` goes by dates instead:
    "other weekday" becomes "other date", and the walk counts every date in
    between, whole weeks included.

    Intermediate values are separate projections, so each is computed once
    and every generated method stays small.
    """
    h = F.col(hours)
    tmp = ["_in_ms", "_out_ms", "_in_day", "_out_day", "_d_in", "_d_out", "_s_in", "_s_out", "_n",
           "_ws", "_we", "_os", "_oe", "_between"]
    between = _dates_between if calendar_exact else _days_between
    d = df.select("*", epoch_ms(incoming).alias("_in_ms"), epoch_ms(outgoing).alias("_out_ms"))
    d = d.select(
        "*",
        (F.col("_in_ms") - F.pmod("_in_ms", F.lit(MS_PER_DAY))).alias("_in_day"),
        (F.col("_out_ms") - F.pmod("_out_ms", F.lit(MS_PER_DAY))).alias("_out_day"),
    )
    d = d.select(
        "*",
        _weekday_of_day_ms(F.col("_in_day")).alias("_d_in"),
        _weekday_of_day_ms(F.col("_out_day")).alias("_d_out"),
    )
    d = d.select(
        "*",
        h[F.col("_d_in")].alias("_s_in"),
        h[F.col("_d_out")].alias("_s_out"),
        (
            ((F.col("_out_day") - F.col("_in_day")) / MS_PER_DAY).cast("long")
            if calendar_exact
            else F.pmod(F.col("_d_out") - F.col("_d_in"), F.lit(7))
        ).alias("_n"),
    )
    ws, we = _placed(F.col("_in_day"), F.col("_s_in"))
    os_, oe = _placed(F.col("_out_day"), F.col("_s_out"))
    d = d.select(
        "*",
        ws.alias("_ws"), we.alias("_we"), os_.alias("_os"), oe.alias("_oe"),
        F.when(F.col("_n") >= 1, between(F.col(walk_prefix), F.col("_d_in"), F.col("_n")))
        .otherwise(F.lit(0).cast("long"))
        .alias("_between"),
    )
    in_ms, out_ms = F.col("_in_ms"), F.col("_out_ms")
    ws, we, os_, oe, n = F.col("_ws"), F.col("_we"), F.col("_os"), F.col("_oe"), F.col("_n")
    has_in = F.col("_s_in").isNotNull()
    has_out = F.col("_s_out").isNotNull()
    out_inside = (out_ms >= os_) & (out_ms <= oe)
    in_inside = (in_ms >= ws) & (in_ms <= we)
    other_day = n != 0
    zero = F.lit(0).cast("long")
    null = F.lit(None).cast("long")
    walk = F.when(n == 0, zero).otherwise(F.col("_between") + (out_ms - os_))
    value = (
        F.when(~has_in & ~has_out, null)
        .when(~has_in & out_inside, F.greatest(zero, walk))
        .when(~has_in, null)
        .when((in_ms >= ws) & (out_ms <= we), out_ms - in_ms)
        .when(in_inside & other_day & has_out & out_inside,
              F.greatest(zero, (we - in_ms) + F.col("_between") + (out_ms - os_)))
        .when(in_inside & other_day, null)
        .when(has_out & ~out_inside, null)
        .when(~in_inside & has_out & out_inside, F.greatest(zero, walk))
        .when(~in_inside, null)
        .when(out_ms > we, we - in_ms)
        .otherwise(null)
    )
    return d.select("*", value.alias(name)).drop(*tmp)


def _weekday_of_day_ms(day_ms: Column) -> Column:
    """Weekday (0 = Sunday) of a UTC midnight given in epoch milliseconds."""
    return F.pmod((day_ms / MS_PER_DAY).cast("long") + 4, F.lit(7)).cast("int")


# --------------------------------------------------------------------------
# Next working period / day (H9, H10)
# --------------------------------------------------------------------------
def _period(day_start_ms: Column, slot: Column, weekday: Column) -> Column:
    start, end = _placed(day_start_ms, slot)
    return F.struct(
        F.timestamp_millis(start).alias("start"),
        F.timestamp_millis(end).alias("end"),
        weekday_name(weekday).alias("day"),
    )


def with_next_working_periods(
    df: DataFrame,
    ts: str,
    hours: str = "hours",
    period: str = "next_period",
    day: str = "next_day",
    next_offset: str = "next_offset",
) -> DataFrame:
    """Add two STRUCT<start, end, day> columns from the weekly slot map
    ``hours``:

    * ``day``: the first slot on the following 7 days (the same weekday a
      week later counts), NULL when the map has none;
    * ``period``: today's slot when ``ts`` is before its end, else ``day``.
    """
    h = F.col(hours)
    d = df.select("*", epoch_ms(ts).alias("_t"))
    d = d.select("*", (F.col("_t") - F.pmod("_t", F.lit(MS_PER_DAY))).alias("_t_day"))
    d = d.select("*", _weekday_of_day_ms(F.col("_t_day")).alias("_d"))
    d = d.select("*", F.get(F.col(next_offset), F.col("_d")).alias("_off"), h[F.col("_d")].alias("_today"))
    nd = F.pmod(F.col("_d") + F.col("_off"), F.lit(7))
    d = d.select("*", nd.alias("_nd"), h[nd].alias("_next_slot"))
    next_day = F.when(
        F.col("_off").isNotNull(),
        _period(F.col("_t_day") + F.col("_off").cast("long") * MS_PER_DAY, F.col("_next_slot"), F.col("_nd")),
    )
    _, today_end = _placed(F.col("_t_day"), F.col("_today"))
    d = d.select("*", next_day.alias(day), today_end.alias("_today_end"))
    current = F.when(
        F.col("_today").isNotNull() & (F.col("_t") < F.col("_today_end")),
        _period(F.col("_t_day"), F.col("_today"), F.col("_d")),
    ).otherwise(F.col(day))
    return d.select("*", current.alias(period)).drop(
        "_t", "_t_day", "_d", "_off", "_today", "_nd", "_next_slot", "_today_end"
    )
