"""Lifetime conversation summary (Q1) and its upsert (Q11).

Plan: drop unattributed messages, LAG direction/timestamp per chat (across
users and days), rate each reply against the weekday slot of its (user, org)
(a broadcast lookup when the calendars are small enough), and aggregate once
per (chat, user, org, agent phone).  The reply average is
keyed by (chat, user, org) only, so it is summed from the per-phone partial
sums with a window over the aggregated rows instead of a second join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import weekday1
from ..functions.worktime import register_functions, working_seconds
from ..operators.hours import pivot_week, weekly_hours_map
from ..operators.joins import lookup_join
from ..operators.lag import HOUR_US, lag_in_order

INCOMING, OUTGOING = "INCOMING", "OUTGOING"
ORDER = ["message_timestamp", "event_id"]



def party(is_outgoing) -> F.Column:
    """OUTGOING -> 'employee', anything else -> 'contact'."""
    return F.when(is_outgoing, "employee").otherwise("contact")


def with_reply_seconds(
    events: DataFrame, working_hours: DataFrame, is_reply: F.Column, prev_ts: str = "prev_message_timestamp"
) -> DataFrame:
    """Join each row's (user, org) weekly hours and add ``working_seconds`` of
    the (previous message -> this message) pair for reply rows (NULL on other
    rows), using the weekday slot of the previous message."""
    df = lookup_join(events, weekly_hours_map(working_hours), ["user_id", "org_id"], ["event_id"])
    slot = F.col("slots")[weekday1(prev_ts)]
    ws = working_seconds(F.col(prev_ts), F.col("message_timestamp"), slot["start_us"], slot["end_us"])
    return df.select("*", F.when(is_reply, ws).alias("working_seconds"))


def function_working_seconds(
    message_events: DataFrame, working_hours: DataFrame, bucket_us: int | None = HOUR_US
) -> DataFrame:
    """(event_id, working_seconds) of every reply pair of a chat, by the
    16-argument SQL function over the weekday-wide hours: what a user of the
    function writes in SQL."""
    register_functions(message_events.sparkSession)
    ev = message_events.where(F.col("user_id").isNotNull()).select(
        "event_id", "chat_id", "user_id", "org_id", "direction", "message_timestamp"
    )
    ev = lag_in_order(ev, ["chat_id"], ORDER, ["direction", "message_timestamp"], bucket_us=bucket_us)
    pairs = ev.where((F.col("direction") == OUTGOING) & (F.col("prev_direction") == INCOMING))
    wide = pivot_week(working_hours)
    pairs = lookup_join(pairs, wide, ["user_id", "org_id"], ["event_id"])
    arguments = ", ".join(["prev_message_timestamp", "message_timestamp", *wide.columns[2:]])
    return pairs.select("event_id", F.expr(f"calculate_working_seconds({arguments})").alias("working_seconds"))


def conversation_summary_flat(
    message_events: DataFrame, working_hours: DataFrame, bucket_us: int | None = HOUR_US
) -> DataFrame:
    ev = message_events.where(F.col("user_id").isNotNull()).select(
        "event_id", "message_id", "chat_id", "user_id", "org_id", "agent_phone_number",
        "direction", "message_timestamp",
    )
    ev = lag_in_order(ev, ["chat_id"], ORDER, ["direction", "message_timestamp"], bucket_us=bucket_us)
    is_in = F.col("direction") == INCOMING
    is_out = F.col("direction") == OUTGOING
    is_reply = is_out & (F.col("prev_direction") == INCOMING)
    ev = with_reply_seconds(ev, working_hours, is_reply)
    counted = F.when(F.col("working_seconds") > 0, F.col("working_seconds"))
    agg = ev.groupBy("chat_id", "user_id", "org_id", "agent_phone_number").agg(
        F.min("message_timestamp").alias("created_at"),
        F.max("message_timestamp").alias("updated_at"),
        F.min_by(is_out.cast("int"), "order_key").alias("_first_out"),
        F.max_by(is_out.cast("int"), "order_key").alias("_last_out"),
        F.count_if(is_in).alias("messages_received"),
        F.count_if(is_out).alias("messages_sent"),
        F.count_distinct("message_id").alias("unique_messages"),
        F.count_if(is_out & (F.col("prev_direction") == OUTGOING)).alias("number_of_follow_ups"),
        F.sum(counted).alias("_ws_sum"),
        F.count(counted).alias("_ws_n"),
    )
    return summary_rows(agg)


def summary_rows(agg: DataFrame) -> DataFrame:
    """The summary of the aggregated (chat, user, org, agent phone) rows; all
    rows of a (chat, user, org) must be there."""
    per_chat_user = Window.partitionBy("chat_id", "user_id", "org_id")
    ws_sum = F.sum("_ws_sum").over(per_chat_user)
    ws_n = F.sum("_ws_n").over(per_chat_user)
    avg = F.when(ws_n > 0, ws_sum / ws_n).otherwise(F.lit(0.0))
    return agg.select(
        "chat_id",
        F.col("user_id").alias("uid"),
        "org_id",
        F.col("agent_phone_number").alias("phone_number"),
        "messages_sent",
        "messages_received",
        (F.col("messages_sent") + F.col("messages_received")).alias("total_messages"),
        "unique_messages",
        "number_of_follow_ups",
        avg.alias("average_response_time"),
        party(F.col("_first_out") == 1).alias("conversation_starter"),
        party(F.col("_last_out") == 1).alias("last_message_from"),
        "created_at",
        "updated_at",
    )


def nest_analytics(flat: DataFrame, keep: list[str]) -> DataFrame:
    """Fold the five counters into the ``analytics`` record."""
    analytics = F.struct(
        "messages_sent", "messages_received", "total_messages", "unique_messages", "number_of_follow_ups"
    ).alias("analytics")
    cols = []
    for c in keep:
        cols.append(analytics if c == "analytics" else F.col(c))
    return flat.select(*cols)


SUMMARY_COLUMNS = [
    "uid", "org_id", "chat_id", "phone_number", "analytics", "average_response_time",
    "conversation_starter", "last_message_from", "updated_at", "created_at",
]


def conversation_summary(message_events: DataFrame, working_hours: DataFrame, bucket_us: int | None = HOUR_US) -> DataFrame:
    """Q1 rows in the conversation_summary table shape (nested analytics)."""
    return nest_analytics(conversation_summary_flat(message_events, working_hours, bucket_us), SUMMARY_COLUMNS)
