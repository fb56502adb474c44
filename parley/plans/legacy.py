"""Legacy per-day summaries keyed by (user, org, date, sender number):
original counts (Q7), the simple summary (Q8) and the enhanced summary with a
working-hours placeholder average (Q9).

All three read the ingestion-date window (``run_date``, ``days``; ``days=None``
keeps all history) and aggregate once; the enhanced version's left join of two
aggregates over the same keys is folded into that single aggregation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import clock_us, epoch_us, time_of_day_us, utc_date, weekday0, weekday_name
from ..operators.ends import code_value, packed, settled, value_code
from ..operators.joins import lookup_join
from ..sources.readers import ingestion_window

INCOMING, OUTGOING = "INCOMING", "OUTGOING"
# Directions with a code of their own; any other is settled from the rows.
DIRECTIONS = ["INCOMING", "OUTGOING", "SYSTEM"]
KEYS = ["user_id", "org_id", "date", "sender_number"]
# The placeholder reply time of the enhanced summary, in seconds.
PLACEHOLDER_SECONDS = 300


def _daily(events: DataFrame, run_date, days) -> DataFrame:
    return ingestion_window(events, run_date, days).withColumn("date", utc_date("message_timestamp"))


def legacy_counts(events: DataFrame, run_date: str | dt.date | None = None, days: int | None = 1) -> DataFrame:
    """Q7: total_sent, total_received, unique_messages per key."""
    d = _daily(events, run_date, days)
    return d.groupBy(*KEYS).agg(
        F.count_if(F.col("direction") == OUTGOING).alias("total_sent"),
        F.count_if(F.col("direction") == INCOMING).alias("total_received"),
        F.count_distinct("message_id").alias("unique_messages"),
    )


def legacy_simple_summary(events: DataFrame, run_date: str | dt.date | None = None, days: int | None = 1) -> DataFrame:
    """Q8: counts plus COUNT(*) and first/last timestamps; follow-ups,
    starter, last sender and average are constants."""
    d = _daily(events, run_date, days)
    return d.groupBy(*KEYS).agg(
        F.count_if(F.col("direction") == OUTGOING).alias("messages_sent"),
        F.count_if(F.col("direction") == INCOMING).alias("messages_received"),
        F.count_distinct("message_id").alias("unique_messages"),
        F.count(F.lit(1)).alias("total_messages"),
        F.lit(0).cast("long").alias("number_of_follow_ups"),
        F.lit(INCOMING).alias("conversation_starter"),
        F.lit(OUTGOING).alias("last_message_from"),
        F.min("message_timestamp").alias("earliest_message"),
        F.max("message_timestamp").alias("latest_message"),
        F.lit(0.0).alias("average_response_time"),
    )


def _slots_by_weekday(hours: DataFrame, keys: list[str]) -> DataFrame:
    """hours rows -> one row per (keys..., weekday name) with the list of
    (start_us, end_us) slots on that weekday (bounded by the configuration)."""
    return hours.groupBy(*keys, F.lower(F.col("week_day")).alias("_weekday")).agg(
        F.collect_list(
            F.struct(clock_us(F.col("start_time")).alias("s"), clock_us(F.col("end_time")).alias("e"))
        ).alias("_slots")
    )


def legacy_enhanced_summary(
    events: DataFrame,
    hours: DataFrame,
    run_date: str | dt.date | None = None,
    days: int | None = 1,
) -> DataFrame:
    """Q9.  ``hours`` has (week_day, start_time, end_time) and optionally
    (user_id, org_id): with the keys each message is checked against its own
    user's hours; without them one calendar applies to every message.

    An OUTGOING message counts PLACEHOLDER_SECONDS when a slot of its
    weekday contains its time of day (inclusive, plain BETWEEN, so an
    overnight slot never matches); the average is 0 when nothing counts or
    when a key is NULL (the original joined the two aggregates with plain
    equality).

    First and last direction come from packed numbers (``operators.ends``), so
    the events are aggregated by hashing; groups with several directions at
    their first or last instant are settled by event id."""
    d = _daily(events, run_date, days)
    everything = d
    keys = [k for k in ("user_id", "org_id") if k in hours.columns]
    d = d.withColumn("_weekday", weekday_name(weekday0("message_timestamp")))
    d = lookup_join(d, _slots_by_weekday(hours, keys), [*keys, "_weekday"], ["event_id"])
    tod = time_of_day_us("message_timestamp")
    in_hours = F.coalesce(F.exists(F.col("_slots"), lambda s: tod.between(s["s"], s["e"])), F.lit(False))
    counted = F.when((F.col("direction") == OUTGOING) & in_hours, F.lit(PLACEHOLDER_SECONDS))
    t, code, width = epoch_us("message_timestamp"), value_code(F.col("direction"), DIRECTIONS), len(DIRECTIONS) + 1
    agg = d.groupBy(*KEYS).agg(
        F.count_if(F.col("direction") == OUTGOING).alias("messages_sent"),
        F.count_if(F.col("direction") == INCOMING).alias("messages_received"),
        F.count_distinct("message_id").alias("unique_messages"),
        F.count(F.lit(1)).alias("total_messages"),
        F.count_if(F.col("direction") == OUTGOING).alias("number_of_follow_ups"),
        F.min(packed(t, code, width)).alias("_first"),
        F.min(packed(t, width - 1 - code, width)).alias("_first_r"),
        F.max(packed(t, code, width)).alias("_last"),
        F.max(packed(t, width - 1 - code, width)).alias("_last_r"),
        F.min("message_timestamp").alias("earliest_message"),
        F.max("message_timestamp").alias("latest_message"),
        F.avg(counted).alias("_avg"),
    )
    # Least and greatest code at the first and at the last instant.
    for end, forward, reverse in (("_f", "_first", "_first_r"), ("_l", "_last", "_last_r")):
        agg = agg.withColumn(end, F.pmod(forward, F.lit(width))).withColumn(
            f"{end}_open", (F.col(end) == 0) | (F.col(end) + F.pmod(reverse, F.lit(width)) != width - 1)
        )
    agg = agg.withColumn("conversation_starter", code_value(F.col("_f"), DIRECTIONS))
    agg = agg.withColumn("last_message_from", code_value(F.col("_l"), DIRECTIONS))
    order = F.struct(t, F.col("event_id"))
    agg = settled(
        agg, KEYS, F.col("_f_open") | F.col("_l_open"), everything,
        {"conversation_starter": F.min_by("direction", order), "last_message_from": F.max_by("direction", order)},
    )
    keys_present = F.col("user_id").isNotNull() & F.col("org_id").isNotNull() & F.col("sender_number").isNotNull()
    avg = F.when(keys_present, F.coalesce(F.col("_avg"), F.lit(0.0))).otherwise(F.lit(0.0))
    return agg.select(
        *KEYS, "messages_sent", "messages_received", "unique_messages", "total_messages", "number_of_follow_ups",
        "conversation_starter", "last_message_from", "earliest_message", "latest_message",
        avg.alias("average_response_time"),
    )
