"""Inputs derived from the driver's read-only tables.

Every fixture is a Spark transformation of ``events`` (or ``conversations``),
so it grows with the data; the DuckDB oracle in ``__spark_entry__`` derives the
same relations with the same expressions.  Derivation rules are listed in
FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import US_PER_SEC, epoch_us, floor_div, instant_from_ntz

def _k() -> Column:
    """The integer field k of the ``props`` column.  The driver's props are
    flat one-key objects ``{"k": n}``, so a key-anchored pattern reads the
    same value as a JSON parser at a third of the cost."""
    return F.regexp_extract(F.col("props"), r'"k"\s*:\s*(-?[0-9]+)', 1).try_cast("long")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _str(c: Column) -> Column:
    return c.cast("string")


def message_events(events: DataFrame) -> DataFrame:
    """message_events rows from driver ``events`` rows (FIXTURES.md §3)."""
    k = _k()
    chat_no = floor_div(F.col("user_id"), 3) * 2 + F.pmod(k, F.lit(2))
    shifted_org = F.col("user_id") + F.when(F.pmod(F.col("event_id"), F.lit(11)) == 0, 1).otherwise(0)
    direction = (
        F.when(F.col("event_type").isin("click", "view"), "INCOMING")
        .when(F.col("event_type").isin("signup", "purchase"), "OUTGOING")
        .otherwise("SYSTEM")
    )
    agent_phone = F.when(F.pmod(F.col("user_id"), F.lit(13)) == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("+1"), _str(F.pmod(F.col("user_id"), F.lit(7))))
    )
    ts = instant_from_ntz("ts")
    base = events.select(
        _str(F.col("event_id")).alias("event_id"),
        F.concat(F.lit("m"), _str(F.pmod(F.col("event_id"), F.lit(23)))).alias("message_id"),
        F.concat(F.lit("c"), _str(chat_no)).alias("chat_id"),
        _str(F.pmod(shifted_org, F.lit(3))).alias("org_id"),
        F.when(F.pmod(F.col("user_id"), F.lit(10)) == 0, F.lit(None).cast("string"))
        .otherwise(_str(F.col("user_id")))
        .alias("user_id"),
        ts.alias("message_timestamp"),
        F.timestamp_micros(epoch_us(ts) + 300 * US_PER_SEC).alias("ingestion_timestamp"),
        direction.alias("direction"),
        F.lit("chat").alias("type"),
        F.lit(None).cast("long").alias("ack"),
        F.lit(None).cast("string").alias("message_text"),
        F.lit(None).cast("string").alias("file_url"),
        (F.pmod(k, F.lit(10)) == 0).alias("is_broadcast"),
        F.col("props").alias("special_data"),
        k.alias("word_count"),
        agent_phone.alias("agent_phone_number"),
        chat_no.alias("_chat_no"),
    )
    sender = F.when(F.col("direction") == "OUTGOING", F.col("agent_phone_number")).otherwise(
        F.concat(F.lit("+9"), _str(F.col("_chat_no")))
    )
    return base.select(
        "event_id", "message_id", "chat_id", "org_id", "user_id", "message_timestamp",
        "ingestion_timestamp", "direction", sender.alias("sender_number"), "type", "ack",
        "message_text", "file_url", "is_broadcast", "special_data", "word_count", "agent_phone_number",
    )


# Warehouse working-hour slots by user_id % 4, as
# (start, end) clock text in UTC: 09:00-18:00, 08:30-17:30, 00:00-23:59:59,
# 22:00-06:00 (overnight).
_SLOTS = [("09:00:00", "18:00:00"), ("08:30:00", "17:30:00"), ("00:00:00", "23:59:59"), ("22:00:00", "06:00:00")]


def _clock_to_us(text: str) -> int:
    h, m, s = (int(p) for p in text.split(":"))
    return (h * 3600 + m * 60 + s) * US_PER_SEC


def working_hours(events: DataFrame) -> DataFrame:
    """Resolved UTC working hours per (user, org, weekday); FIXTURES.md §3."""
    users = events.select("user_id").distinct().where(F.pmod(F.col("user_id"), F.lit(10)) != 1)
    slot = F.pmod(F.col("user_id"), F.lit(4))
    start = F.element_at(F.array(*[F.lit(_clock_to_us(s)) for s, _ in _SLOTS]), (slot + 1).cast("int"))
    end = F.element_at(F.array(*[F.lit(_clock_to_us(e)) for _, e in _SLOTS]), (slot + 1).cast("int"))
    days = F.when(F.pmod(F.col("user_id"), F.lit(8)) == 2, F.sequence(F.lit(1), F.lit(7))).otherwise(
        F.sequence(F.lit(2), F.lit(6))
    )
    return users.select(
        _str(F.col("user_id")).alias("user_id"),
        F.explode(F.array(F.lit("0"), F.lit("1"))).alias("org_id"),
        days.alias("_days"),
        start.alias("start_us"),
        end.alias("end_us"),
    ).select("user_id", "org_id", F.explode("_days").alias("day_of_week"), "start_us", "end_us")


def user_mapping(events: DataFrame) -> DataFrame:
    """user_id -> team/org mapping; users with user_id % 17 = 0 get a second
    row in the next org.  ``row_order`` records the read order (0 first)."""
    users = events.select("user_id").distinct()
    order = F.when(F.pmod(F.col("user_id"), F.lit(17)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = users.select("user_id", F.explode(order).alias("row_order"))
    return rows.select(
        "user_id",
        F.pmod(F.col("user_id"), F.lit(5)).alias("team_id"),
        (F.pmod(F.col("user_id"), F.lit(3)) + F.col("row_order")).alias("org_id"),
        "row_order",
    )


# The relational configuration derived for the fixtures.
#   self rows  (user_id % 6 = 0): monday..friday 08:00:00-16:30:00 when
#              user_id % 12 = 0, else 10:00:00-19:00:00; offset 0.
#              user_id % 60 = 6 stores monday and tuesday as one SET value
#              'monday,tuesday'; user_id % 60 = 12 writes 'Friday'.
#              user_id % 60 = 24 has a second monday row 07:00:00-12:00:00.
#   team rows  team 0: monday..saturday 09:00:00-17:00:00, offset 60;
#              team 1: sunday..thursday 22:00:00-06:00:00 (overnight), offset 60.
#   org rows   org 0: all seven days 06:00:00-20:00:00, offset -120.
_WEEKDAYS_MON_FIRST = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def working_hours_config(mapping: DataFrame) -> DataFrame:
    """Relational (type, type_id, week_day, start_time, end_time,
    timezone_offset) rows derived from the user mapping."""
    users = mapping.select("user_id").distinct().where(F.pmod(F.col("user_id"), F.lit(6)) == 0)
    u60 = F.pmod(F.col("user_id"), F.lit(60))
    weekdays = F.when(
        u60 == 6, F.array(*[F.lit(d) for d in ["monday,tuesday", "wednesday", "thursday", "friday"]])
    ).when(
        u60 == 12, F.array(*[F.lit(d) for d in ["monday", "tuesday", "wednesday", "thursday", "Friday"]])
    ).otherwise(F.array(*[F.lit(d) for d in _WEEKDAYS_MON_FIRST[:5]]))
    early = F.pmod(F.col("user_id"), F.lit(12)) == 0
    self_rows = users.select(
        F.lit("self").alias("type"),
        F.col("user_id").cast("long").alias("type_id"),
        F.explode(weekdays).alias("week_day"),
        F.when(early, "08:00:00").otherwise("10:00:00").alias("start_time"),
        F.when(early, "16:30:00").otherwise("19:00:00").alias("end_time"),
        F.lit(0).alias("timezone_offset"),
    )
    extra_rows = users.where(u60 == 24).select(
        F.lit("self").alias("type"),
        F.col("user_id").cast("long").alias("type_id"),
        F.lit("monday").alias("week_day"),
        F.lit("07:00:00").alias("start_time"),
        F.lit("12:00:00").alias("end_time"),
        F.lit(0).alias("timezone_offset"),
    )
    teams = mapping.select("team_id").distinct().where(F.col("team_id").isin(0, 1))
    team_days = F.when(F.col("team_id") == 0, F.array(*[F.lit(d) for d in _WEEKDAYS_MON_FIRST[:6]])).otherwise(
        F.array(*[F.lit(d) for d in ["sunday", "monday", "tuesday", "wednesday", "thursday"]])
    )
    team_rows = teams.select(
        F.lit("team").alias("type"),
        F.col("team_id").cast("long").alias("type_id"),
        F.explode(team_days).alias("week_day"),
        F.when(F.col("team_id") == 0, "09:00:00").otherwise("22:00:00").alias("start_time"),
        F.when(F.col("team_id") == 0, "17:00:00").otherwise("06:00:00").alias("end_time"),
        F.lit(60).alias("timezone_offset"),
    )
    orgs = mapping.select("org_id").distinct().where(F.col("org_id") == 0)
    org_rows = orgs.select(
        F.lit("org").alias("type"),
        F.col("org_id").cast("long").alias("type_id"),
        F.explode(F.array(*[F.lit(d) for d in _WEEKDAYS_MON_FIRST])).alias("week_day"),
        F.lit("06:00:00").alias("start_time"),
        F.lit("20:00:00").alias("end_time"),
        F.lit(-120).alias("timezone_offset"),
    )
    return self_rows.unionByName(extra_rows).unionByName(team_rows).unionByName(org_rows)


def conversation_events(conversations: DataFrame) -> DataFrame:
    """message_events rows from driver ``conversations`` turns: chat = conv_id,
    user -> INCOMING, assistant -> OUTGOING, system -> SYSTEM; timestamp =
    2024-01-01 09:00 UTC + conv_id hours + turn x 3 minutes."""
    base_us = 1_704_099_600 * US_PER_SEC  # 2024-01-01 09:00:00 UTC
    ts = F.timestamp_micros(
        F.lit(base_us) + F.col("conv_id") * 3_600 * US_PER_SEC + F.col("turn") * 180 * US_PER_SEC
    )
    direction = (
        F.when(F.col("role") == "user", "INCOMING")
        .when(F.col("role") == "assistant", "OUTGOING")
        .otherwise("SYSTEM")
    )
    agent_phone = F.concat(F.lit("+2"), _str(F.pmod(F.col("conv_id"), F.lit(4))))
    return conversations.select(
        _str(F.col("conv_id") * 100_000 + F.col("turn")).alias("event_id"),
        F.concat(F.lit("t"), _str(F.col("conv_id")), F.lit("-"), _str(F.col("turn"))).alias("message_id"),
        _str(F.col("conv_id")).alias("chat_id"),
        _str(F.pmod(F.col("conv_id"), F.lit(2))).alias("org_id"),
        _str(F.pmod(F.col("conv_id"), F.lit(13))).alias("user_id"),
        ts.alias("message_timestamp"),
        F.timestamp_micros(epoch_us(ts) + 300 * US_PER_SEC).alias("ingestion_timestamp"),
        direction.alias("direction"),
        F.when(direction == "OUTGOING", agent_phone)
        .otherwise(F.concat(F.lit("+8"), _str(F.col("conv_id"))))
        .alias("sender_number"),
        F.lit("chat").alias("type"),
        F.lit(None).cast("long").alias("ack"),
        F.col("text").alias("message_text"),
        F.lit(None).cast("string").alias("file_url"),
        F.lit(False).alias("is_broadcast"),
        F.lit(None).cast("string").alias("special_data"),
        F.size(F.split(F.col("text"), r"\s+")).cast("long").alias("word_count"),
        agent_phone.alias("agent_phone_number"),
    )
