"""Declared table schemas (REQUIRED columns are non-nullable fields).

Times of day are carried as BIGINT microseconds since midnight (UTC), because
Spark has no usable TIME type; text clock values from the relational
configuration stay strings until they are parsed by ``functions.timecols``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, required: bool = False) -> T.StructField:
    return T.StructField(name, dtype, nullable=not required)


S, L, I, D, B, TS, DT = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
    T.DateType(),
)

MESSAGE_EVENTS = T.StructType(
    [
        _f("event_id", S, True),
        _f("message_id", S, True),
        _f("chat_id", S, True),
        _f("org_id", S, True),
        _f("user_id", S),
        _f("message_timestamp", TS, True),
        _f("ingestion_timestamp", TS, True),
        _f("direction", S, True),
        _f("sender_number", S),
        _f("type", S, True),
        _f("ack", L),
        _f("message_text", S),
        _f("file_url", S),
        _f("is_broadcast", B),
        _f("special_data", S),
        _f("word_count", L),
        _f("agent_phone_number", S),
    ]
)

# Warehouse working hours, already in UTC: one row per (user, org, weekday)
# slot; day_of_week uses 1 = Sunday .. 7 = Saturday.
WORKING_HOURS = T.StructType(
    [
        _f("user_id", S),
        _f("org_id", S),
        _f("day_of_week", I),
        _f("start_us", L),
        _f("end_us", L),
    ]
)

# Relational configuration: type in {self, team, org}; week_day may be a SET
# ("monday,tuesday"); times are 'HH:MM:SS' text.
WORKING_HOURS_CONFIG = T.StructType(
    [
        _f("type", S),
        _f("type_id", L),
        _f("week_day", S),
        _f("start_time", S),
        _f("end_time", S),
        _f("timezone_offset", I),
    ]
)

USER_MAPPING = T.StructType([_f("user_id", L), _f("team_id", L), _f("org_id", L)])

ANALYTICS = T.StructType(
    [
        _f("messages_sent", L),
        _f("messages_received", L),
        _f("total_messages", L),
        _f("unique_messages", L),
        _f("number_of_follow_ups", L),
    ]
)

CONVERSATION_SUMMARY = T.StructType(
    [
        _f("uid", S, True),
        _f("org_id", S, True),
        _f("chat_id", S, True),
        _f("phone_number", S),
        _f("analytics", ANALYTICS, True),
        _f("average_response_time", D),
        _f("conversation_starter", S),
        _f("last_message_from", S),
        _f("updated_at", TS, True),
        _f("created_at", TS, True),
    ]
)

DAILY_PERFORMANCE_SUMMARY = T.StructType(
    [
        _f("activity_date", DT, True),
        _f("user_id", S),
        _f("user_number", S),
        _f("contact_id", S),
        _f("org_id", L),
        _f("conversation_starter_of_day", S),
        _f("agent_message_count", L),
        _f("contact_message_count", L),
        _f("avg_agent_response_time_seconds", D),
        _f("time_to_first_response_seconds", D),
        _f("created_at", TS),
        _f("updated_at", TS),
        _f("analytics", ANALYTICS),
    ]
)

LEGACY_ANALYTICS = T.StructType(
    [_f("total_sent", L), _f("total_received", L), _f("unique_messages", L)]
)

# The per-day summary written by the legacy merges (it has a `date` column and
# no chat_id, unlike CONVERSATION_SUMMARY).
LEGACY_SUMMARY = T.StructType(
    [
        _f("uid", S),
        _f("org_id", S),
        _f("date", DT),
        _f("phone_number", S),
        _f("analytics", LEGACY_ANALYTICS),
        _f("updated_at", TS),
        _f("created_at", TS),
    ]
)

LEGACY_SUMMARY_FULL = T.StructType(
    [
        _f("uid", S),
        _f("org_id", S),
        _f("date", DT),
        _f("phone_number", S),
        _f("analytics", ANALYTICS),
        _f("average_response_time", D),
        _f("conversation_starter", S),
        _f("last_message_from", S),
        _f("updated_at", TS),
        _f("created_at", TS),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df``'s columns to ``schema`` (by name, in order)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def assert_schema(df: DataFrame, schema: T.StructType) -> None:
    """Names and types must equal the declaration (nullability is a data
    property, checked by ``sources.required``)."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if got != want:
        raise AssertionError(f"schema mismatch:\n got  {got}\n want {want}")
