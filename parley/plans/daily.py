"""Daily performance summary (Q2) and its upsert (Q12).

LAG runs per (user, chat) across days and orgs; unattributed messages are
dropped.  The reply average of a (user, chat, date) is not keyed by
org or agent phone, so each aggregated row carries partial sums that a window
over (user, chat, date) combines -- no correlated subquery, no second pass
over the events.  Time to first response needs the (user, org) hours after
aggregation and is a lookup join on the aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import utc_date, weekday1
from ..functions.worktime import working_seconds
from ..operators.hours import weekly_hours_map
from ..operators.joins import lookup_join
from ..operators.lag import HOUR_US, lag_in_order
from .conversation import INCOMING, ORDER, OUTGOING, party, with_reply_seconds



def daily_performance_flat(
    message_events: DataFrame, working_hours: DataFrame, bucket_us: int | None = HOUR_US
) -> DataFrame:
    ev = message_events.select(
        "event_id", "message_id", "chat_id", "user_id", "org_id", "agent_phone_number",
        "direction", "message_timestamp",
    )
    # user_id is a partition key of the LAG: dropping its NULLs first is the same.
    ev = ev.where(F.col("user_id").isNotNull())
    ev = lag_in_order(ev, ["user_id", "chat_id"], ORDER, ["direction", "message_timestamp"], bucket_us=bucket_us)
    is_in = F.col("direction") == INCOMING
    is_out = F.col("direction") == OUTGOING
    is_reply = is_out & (F.col("prev_direction") == INCOMING) & F.col("prev_message_timestamp").isNotNull()
    ev = with_reply_seconds(ev, working_hours, is_reply).withColumn("activity_date", utc_date("message_timestamp"))
    counted = F.when(F.col("working_seconds") > 0, F.col("working_seconds"))
    agg = ev.groupBy("activity_date", "user_id", "org_id", "chat_id", "agent_phone_number").agg(
        F.min_by(is_out.cast("int"), "order_key").alias("_first_out"),
        F.count_if(is_in).alias("contact_message_count"),
        F.count_if(is_out).alias("agent_message_count"),
        F.min(F.when(is_in, F.col("message_timestamp"))).alias("_first_contact"),
        F.min(F.when(is_out, F.col("message_timestamp"))).alias("_first_agent"),
        F.count_distinct("message_id").alias("unique_messages"),
        F.count_if(is_out & (F.col("prev_direction") == OUTGOING)).alias("number_of_follow_ups"),
        F.sum(counted).alias("_ws_sum"),
        F.count(counted).alias("_ws_n"),
    )
    return daily_rows(agg, working_hours)


def daily_rows(agg: DataFrame, working_hours: DataFrame) -> DataFrame:
    """The daily rows of the aggregated (date, user, org, chat, agent phone)
    rows; all rows of a (user, chat, date) must be there."""
    same_day_chat = Window.partitionBy("user_id", "chat_id", "activity_date")
    ws_sum = F.sum("_ws_sum").over(same_day_chat)
    ws_n = F.sum("_ws_n").over(same_day_chat)
    agg = agg.select("*", F.when(ws_n > 0, ws_sum / ws_n).alias("avg_agent_response_time_seconds"))

    spread = ["chat_id", "activity_date", "agent_phone_number"]
    agg = lookup_join(agg, weekly_hours_map(working_hours), ["user_id", "org_id"], spread)
    slot = F.col("slots")[weekday1("_first_contact")]
    first_response = F.when(
        F.col("_first_agent") > F.col("_first_contact"),
        F.when(
            F.col("slots").isNotNull(),
            working_seconds(F.col("_first_contact"), F.col("_first_agent"), slot["start_us"], slot["end_us"]),
        ),
    )
    return agg.select(
        "activity_date",
        "user_id",
        F.col("chat_id").alias("contact_id"),
        "agent_phone_number",
        "org_id",
        party(F.col("_first_out") == 1).alias("conversation_starter_of_day"),
        "agent_message_count",
        "contact_message_count",
        F.col("agent_message_count").alias("messages_sent"),
        F.col("contact_message_count").alias("messages_received"),
        (F.col("agent_message_count") + F.col("contact_message_count")).alias("total_messages"),
        "unique_messages",
        "number_of_follow_ups",
        "avg_agent_response_time_seconds",
        first_response.alias("time_to_first_response_seconds"),
    )


SUMMARY_SOURCE_COLUMNS = [
    "activity_date", "user_id", "contact_id", "agent_phone_number", "org_id",
    "conversation_starter_of_day", "agent_message_count", "contact_message_count", "analytics",
    "avg_agent_response_time_seconds", "time_to_first_response_seconds",
]


def daily_performance(message_events: DataFrame, working_hours: DataFrame, bucket_us: int | None = HOUR_US) -> DataFrame:
    """Q2 source rows with the nested ``analytics`` record."""
    from .conversation import nest_analytics

    return nest_analytics(daily_performance_flat(message_events, working_hours, bucket_us), SUMMARY_SOURCE_COLUMNS)
