"""Per-user response times (Q3 adjusted for working hours, Q4 raw).

Pairing rule: inside one (user, org, chat, UTC date) group, an OUTGOING
message answers the nearest preceding INCOMING message when no OUTGOING
message lies between them; other directions neither pair nor break a pair.
That is one LAG over the INCOMING/OUTGOING rows only -- an O(n log n) sort
instead of nested scans.

Times are whole milliseconds (what the original timestamps held after being
read as JS dates).  Group averages are rounded half up with exact integer
arithmetic.  The result is keyed by (user, org, phone, date) where the phone is
the first kept reply's sender number; when several chats collapse onto one key
the chat that sorts last wins, as the original keyed map overwrote earlier
chats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import epoch_ms, leading_int, utc_date
from ..functions.worktime import with_adjusted_response_ms
from ..operators.joins import lookup_join
from ..operators.lag import HOUR_US, lag_in_order

INCOMING, OUTGOING = "INCOMING", "OUTGOING"
GROUP = ["user_id", "org_id", "chat_id", "date"]
ORDER = ["message_timestamp", "event_id"]


def _with_date(messages: DataFrame) -> DataFrame:
    return messages if "date" in messages.columns else messages.withColumn("date", utc_date("message_timestamp"))


def response_pairs(
    messages: DataFrame, bucket_us: int | None = HOUR_US, group: list[str] = GROUP
) -> DataFrame:
    """One row per (INCOMING -> OUTGOING) reply pair within ``group``, with
    ``event_id`` of the reply, ``incoming_ts``, ``outgoing_ts``, ``raw_ms`` and
    the reply's ``order_key``."""
    m = _with_date(messages).where(F.col("direction").isin(INCOMING, OUTGOING))
    m = m.select(*GROUP, "event_id", "sender_number", "direction", "message_timestamp")
    m = lag_in_order(m, group, ORDER, ["direction", "message_timestamp"], bucket_us=bucket_us)
    pairs = m.where((F.col("direction") == OUTGOING) & (F.col("prev_direction") == INCOMING))
    return pairs.select(
        *GROUP,
        "event_id",
        "sender_number",
        "order_key",
        F.col("prev_message_timestamp").alias("incoming_ts"),
        F.col("message_timestamp").alias("outgoing_ts"),
        (epoch_ms("message_timestamp") - epoch_ms("prev_message_timestamp")).alias("raw_ms"),
    )


def _floor_div(num: Column, den: Column) -> Column:
    """Exact floor division of non-negative longs."""
    return ((num - F.pmod(num, den)) / den).cast("long")


def group_stats(pairs: DataFrame, value_col: str = "response_ms") -> DataFrame:
    """Per (user, org, chat, date): ``_n`` kept replies, their sum, the
    rounded average ``avg_response_time`` (NULL when none is kept), the first
    kept reply's sender number, and the counters ``_pairs`` (all replies) and
    ``_adjusted`` (kept after a working-hours adjustment)."""
    # No row filter on the value: a filter would be pushed below the staged
    # projections and inline the whole rule into one predicate.  sum/count
    # skip NULLs and min_by skips rows whose ordering key is NULL.
    kept = F.col(value_col).isNotNull()
    adjusted = F.col("has_hours") & kept if "has_hours" in pairs.columns else F.lit(False)
    # By sender first: every buffer has a fixed width, so the pairs are
    # aggregated by hashing.  The first sender is then picked among the few
    # senders of a group.
    senders = pairs.groupBy(*GROUP, "sender_number").agg(
        F.sum(value_col).alias("_sum_ms"),
        F.count(value_col).alias("_n"),
        F.min(F.when(kept, F.col("order_key"))).alias("_first"),
        F.count(F.lit(1)).alias("_pairs"),
        F.count_if(adjusted).alias("_adjusted"),
    )
    g = senders.groupBy(*GROUP).agg(
        F.sum("_sum_ms").alias("_sum_ms"),
        F.sum("_n").alias("_n"),
        F.min_by("sender_number", "_first").alias("phone_number"),
        F.sum("_pairs").alias("_pairs"),
        F.sum("_adjusted").alias("_adjusted"),
    )
    # round(sum / n / 1000) half up == floor((2*sum + 1000*n) / (2000*n))
    avg = F.when(F.col("_n") > 0, _floor_div(2 * F.col("_sum_ms") + 1000 * F.col("_n"), 2000 * F.col("_n")))
    return g.select("*", avg.alias("avg_response_time"))


def group_averages(pairs: DataFrame, value_col: str = "response_ms") -> DataFrame:
    """Average kept reply time per (user, org, chat, date), in whole seconds
    rounded half up, and the first kept reply's sender number."""
    return group_stats(pairs, value_col).where(F.col("_n") > 0).select(
        *GROUP, "phone_number", "avg_response_time", "_n"
    )


RECORD = ["user_id", "org_id", "phone_number", "date"]


def last_chat_average(groups: DataFrame, *more: Column) -> DataFrame:
    """Per (user, org, phone, date): the average of the kept chat that sorts
    last, and the aggregates ``more``; its input is one row per group."""
    last = F.max_by("avg_response_time", F.when(F.col("_n") > 0, F.col("chat_id")))
    return groups.groupBy(*RECORD).agg(last.alias("avg_response_time"), *more)


def collapse_by_phone(groups: DataFrame) -> DataFrame:
    """(user, org, phone, date) records; the last chat (in chat order) wins."""
    return last_chat_average(groups).select(
        leading_int("user_id").alias("user_id"),
        leading_int("org_id").alias("org_id"),
        "phone_number",
        "date",
        "avg_response_time",
    )


def raw_response_times(messages: DataFrame, bucket_us: int | None = HOUR_US) -> DataFrame:
    """Q4: response time records without any working-hours correction."""
    pairs = response_pairs(messages, bucket_us).withColumn("response_ms", F.col("raw_ms"))
    return collapse_by_phone(group_averages(pairs))


def adjusted_pairs(messages: DataFrame, hours_map: DataFrame, bucket_us: int | None = HOUR_US) -> DataFrame:
    """Reply pairs with ``response_ms``: adjusted by the (user, org) weekly
    slot map when the user has configuration (NULL = filtered out), raw
    otherwise.  ``has_hours`` tells which."""
    pairs = response_pairs(messages, bucket_us)
    hours = hours_map.select("user_id", "org_id", "hours", "walk_prefix")
    p = lookup_join(pairs, hours, ["user_id", "org_id"], ["event_id"])
    p = with_adjusted_response_ms(p, "incoming_ts", "outgoing_ts", "hours", "_adjusted_ms")
    has_hours = F.col("hours").isNotNull()
    value = F.when(has_hours, F.col("_adjusted_ms")).otherwise(F.col("raw_ms"))
    return p.select(*[c for c in pairs.columns], has_hours.alias("has_hours"), value.alias("response_ms"))


def lifetime_response_pairs(messages: DataFrame, hours_map: DataFrame, bucket_us: int | None = HOUR_US) -> DataFrame:
    """Every reply pair of a (user, org, chat) over all its history, replies on
    later dates included, with the raw time and the message-level rule by
    weekdays (``adjusted_ms``) and by dates (``exact_ms``); both NULL where the
    pair is filtered out or the user has no configuration."""
    pairs = response_pairs(messages, bucket_us, ["user_id", "org_id", "chat_id"])
    hours = hours_map.select("user_id", "org_id", "hours", "walk_prefix")
    p = lookup_join(pairs, hours, ["user_id", "org_id"], ["event_id"])
    p = with_adjusted_response_ms(p, "incoming_ts", "outgoing_ts", "hours", "adjusted_ms")
    p = with_adjusted_response_ms(p, "incoming_ts", "outgoing_ts", "hours", "exact_ms", calendar_exact=True)
    return p.select(
        "event_id", "user_id", "org_id", "chat_id", "incoming_ts", "outgoing_ts", "raw_ms",
        F.col("hours").isNotNull().alias("has_hours"), "adjusted_ms", "exact_ms",
    )


def adjusted_response_times(messages: DataFrame, hours_map: DataFrame, bucket_us: int | None = HOUR_US) -> DataFrame:
    """Q3: working-hours adjusted response time records."""
    return collapse_by_phone(group_averages(adjusted_pairs(messages, hours_map, bucket_us)))


def adjusted_response_times_by_chat(messages: DataFrame, hours_map: DataFrame, bucket_us: int | None = HOUR_US) -> DataFrame:
    """Q3 before the phone collapse: one record per (user, org, chat, date)."""
    g = group_averages(adjusted_pairs(messages, hours_map, bucket_us))
    return g.select(
        leading_int("user_id").alias("user_id"),
        leading_int("org_id").alias("org_id"),
        "chat_id",
        "phone_number",
        "date",
        "avg_response_time",
    )
