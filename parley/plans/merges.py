"""Upserts of the computed rows into their summary tables (M1 - M5).

Each function takes the current target snapshot and the freshly computed
source rows and returns the next snapshot (see ``operators.upsert``).
``run_ts`` stands for the statement's CURRENT_TIMESTAMP and is a parameter,
so reruns are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import utc_timestamp_literal
from ..operators.upsert import S, upsert
from ..sources import schemas

ANALYTICS_FIELDS = ["messages_sent", "messages_received", "total_messages", "unique_messages", "number_of_follow_ups"]


def merge_conversation_summary(target: DataFrame, source: DataFrame, null_safe: bool = True) -> DataFrame:
    """M1: keys (uid, org_id, chat_id, phone_number).  Matched rows take the
    new analytics, average, starter, last sender and updated_at and keep
    created_at; new keys insert every column."""
    update = {c: S(c) for c in ["org_id", "analytics", "average_response_time", "conversation_starter",
                                "last_message_from", "updated_at"]}
    insert = {f.name: S(f.name) for f in schemas.CONVERSATION_SUMMARY.fields}
    # The source is an aggregate on the merge key: no duplicates to count.
    return upsert(
        target, source, ["uid", "org_id", "chat_id", "phone_number"], update, insert, null_safe, check_unique=False
    )


def daily_target_rows(source: DataFrame, run_ts) -> DataFrame:
    """Daily source rows in the target's shape (as a first run inserts them)."""
    now = utc_timestamp_literal(run_ts)
    return source.select(
        "activity_date",
        "user_id",
        F.col("agent_phone_number").alias("user_number"),
        "contact_id",
        F.col("org_id").try_cast("long").alias("org_id"),
        "conversation_starter_of_day",
        "agent_message_count",
        "contact_message_count",
        "avg_agent_response_time_seconds",
        "time_to_first_response_seconds",
        now.alias("created_at"),
        now.alias("updated_at"),
        "analytics",
    )


def merge_daily_performance(target: DataFrame, source: DataFrame, run_ts, null_safe: bool = True) -> DataFrame:
    """M2: keys (activity_date, user_id, org_id, contact_id, user_number =
    agent_phone_number).  The source org_id (text) is compared as BIGINT."""
    now = utc_timestamp_literal(run_ts)
    number = F.col("org_id").try_cast("long")
    bad = F.col("org_id").isNotNull() & number.isNull()
    src = source.withColumn(
        "_org_num",
        F.when(bad, F.raise_error(F.concat(F.lit("org_id is not a number: "), F.col("org_id"))).cast("long")).otherwise(number),
    )
    keys = {
        "activity_date": "activity_date",
        "user_id": "user_id",
        "org_id": "_org_num",
        "contact_id": "contact_id",
        "user_number": "agent_phone_number",
    }
    update = {
        "org_id": S("_org_num"),
        "conversation_starter_of_day": S("conversation_starter_of_day"),
        "agent_message_count": S("agent_message_count"),
        "contact_message_count": S("contact_message_count"),
        "avg_agent_response_time_seconds": S("avg_agent_response_time_seconds"),
        "time_to_first_response_seconds": S("time_to_first_response_seconds"),
        "analytics": S("analytics"),
        "updated_at": now,
    }
    insert = {
        "activity_date": S("activity_date"),
        "user_id": S("user_id"),
        "user_number": S("agent_phone_number"),
        "contact_id": S("contact_id"),
        "org_id": S("_org_num"),
        "conversation_starter_of_day": S("conversation_starter_of_day"),
        "agent_message_count": S("agent_message_count"),
        "contact_message_count": S("contact_message_count"),
        "avg_agent_response_time_seconds": S("avg_agent_response_time_seconds"),
        "time_to_first_response_seconds": S("time_to_first_response_seconds"),
        "analytics": S("analytics"),
        "created_at": now,
        "updated_at": now,
    }
    return upsert(target, src, keys, update, insert, null_safe)


_LEGACY_KEYS = {"uid": "user_id", "org_id": "org_id", "date": "date", "phone_number": "sender_number"}


def merge_legacy_counts(target: DataFrame, counts: DataFrame, run_ts, null_safe=("phone_number",)) -> DataFrame:
    """M3: the original merge; the phone key is compared null-safely, the
    other keys with plain equality (pass ``null_safe=True`` for all)."""
    now = utc_timestamp_literal(run_ts)
    analytics = F.struct(
        S("total_sent").alias("total_sent"),
        S("total_received").alias("total_received"),
        S("unique_messages").alias("unique_messages"),
    )
    update = {"analytics": analytics, "updated_at": now}
    insert = {
        "uid": S("user_id"), "org_id": S("org_id"), "date": S("date"), "phone_number": S("sender_number"),
        "analytics": analytics, "updated_at": now, "created_at": now,
    }
    return upsert(target, counts, _LEGACY_KEYS, update, insert, null_safe, check_unique=False)


def merge_legacy_summary(target: DataFrame, summary: DataFrame, run_ts, null_safe=("phone_number",)) -> DataFrame:
    """M4 / M5: the simple and enhanced merges (same actions); inserted rows
    take created_at from the earliest message."""
    now = utc_timestamp_literal(run_ts)
    analytics = F.struct(*[S(c).alias(c) for c in ANALYTICS_FIELDS])
    update = {
        "analytics": analytics,
        "average_response_time": S("average_response_time"),
        "conversation_starter": S("conversation_starter"),
        "last_message_from": S("last_message_from"),
        "updated_at": now,
    }
    insert = {
        "uid": S("user_id"), "org_id": S("org_id"), "date": S("date"), "phone_number": S("sender_number"),
        "analytics": analytics,
        "average_response_time": S("average_response_time"),
        "conversation_starter": S("conversation_starter"),
        "last_message_from": S("last_message_from"),
        "updated_at": now,
        "created_at": S("earliest_message"),
    }
    return upsert(target, summary, _LEGACY_KEYS, update, insert, null_safe, check_unique=False)


def legacy_counts_rows(counts: DataFrame, run_ts) -> DataFrame:
    """Legacy counts in the legacy table's shape (as a first run inserts them)."""
    now = utc_timestamp_literal(run_ts)
    return counts.select(
        F.col("user_id").alias("uid"), "org_id", "date", F.col("sender_number").alias("phone_number"),
        F.struct("total_sent", "total_received", "unique_messages").alias("analytics"),
        now.alias("updated_at"), now.alias("created_at"),
    )


def legacy_summary_rows(summary: DataFrame, run_ts) -> DataFrame:
    """Legacy simple/enhanced summaries in the table's shape (first run)."""
    now = utc_timestamp_literal(run_ts)
    return summary.select(
        F.col("user_id").alias("uid"), "org_id", "date", F.col("sender_number").alias("phone_number"),
        F.struct(*ANALYTICS_FIELDS).alias("analytics"),
        F.col("average_response_time").cast("double").alias("average_response_time"),
        "conversation_starter", "last_message_from",
        now.alias("updated_at"), F.col("earliest_message").alias("created_at"),
    )


def flatten_analytics(df: DataFrame) -> DataFrame:
    """Replace the nested ``analytics`` record by its fields (for comparisons)."""
    fields = df.schema["analytics"].dataType.fieldNames()
    cols = []
    for c in df.columns:
        if c == "analytics":
            cols += [F.col(f"analytics.{f}").alias(f) for f in fields]
        else:
            cols.append(F.col(c))
    return df.select(*cols)
