"""Per-user response-time report (Q10): message statistics (A17), the
response-time records (Q3) with their summary (A18) and run counters (A19).

The original ran this for one user at a time, buffering that user's rows in
one process.  Here every user's report is one grouped job; a single user's
report is the same DataFrame filtered on user_id, and the per-user
distribution maps are bounded by the dates in the window and the direction
values.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.readers import project_messages
from .response import INCOMING, OUTGOING, adjusted_pairs, collapse_by_phone, group_stats, last_chat_average


def user_messages(messages: DataFrame, user_id=None, run_date=None, days: int | None = None) -> DataFrame:
    """The response-time projection of attributed messages (S4, F5)."""
    df = project_messages(messages, user_id, run_date, days)
    return df.where(F.col("user_id").isNotNull())


GRAIN = ["user_id", "org_id", "chat_id", "date", "sender_number", "direction"]


def message_grain(messages: DataFrame) -> DataFrame:
    """The mergeable grain of the message statistics: messages per (user, org,
    chat, date, sender, direction).  Grains of disjoint batches add up, and
    every count and distribution below comes from it."""
    return messages.groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("messages"))


def message_statistics(grain: DataFrame) -> DataFrame:
    """Per user: totals, incoming, outgoing, distinct chats and conversation
    groups (user, org, chat, date), and distinct sender numbers (an absent
    number counts as one value).

    Groups roll up to chats and chats to users, so a distinct count is a count
    of rows one level below and no row is expanded per distinct column."""
    n = F.col("messages")
    groups = grain.groupBy("user_id", "chat_id", "org_id", "date").agg(
        F.sum(n).alias("messages"),
        F.sum(F.when(F.col("direction") == INCOMING, n).otherwise(0)).alias("incoming"),
        F.sum(F.when(F.col("direction") == OUTGOING, n).otherwise(0)).alias("outgoing"),
    )
    chats = groups.groupBy("user_id", "chat_id").agg(
        F.count(F.lit(1)).alias("groups"), *[F.sum(c).alias(c) for c in ("messages", "incoming", "outgoing")]
    )
    totals = chats.groupBy("user_id").agg(
        F.sum("messages").alias("message_count"),
        F.sum("incoming").alias("incoming_messages"),
        F.sum("outgoing").alias("outgoing_messages"),
        F.count(F.lit(1)).alias("unique_chats"),
        F.sum("groups").alias("conversation_groups"),
    )
    senders = grain.select("user_id", "sender_number").distinct().groupBy("user_id").agg(
        F.count(F.lit(1)).alias("unique_phone_numbers")
    )
    return totals.join(senders, "user_id")


def message_distribution(messages: DataFrame) -> DataFrame:
    """Long form of the two distributions: (user_id, kind, key, messages)
    with kind 'date' (UTC date text) or 'direction'.  One scan: both come from
    the messages per (user, date, direction)."""
    counts = messages.groupBy("user_id", "date", "direction").agg(F.count(F.lit(1)).alias("messages"))
    kinds = F.array(
        F.struct(F.lit("date").alias("kind"), F.col("date").cast("string").alias("key")),
        F.struct(F.lit("direction").alias("kind"), F.col("direction").alias("key")),
    )
    long = counts.select("user_id", F.explode(kinds).alias("_k"), "messages").select("user_id", "_k.kind", "_k.key", "messages")
    return long.groupBy("user_id", "kind", "key").agg(F.sum("messages").alias("messages")).select(
        "user_id", "kind", "key", "messages"
    )


def distribution_maps(distribution: DataFrame) -> DataFrame:
    """(user_id, date_distribution MAP, direction_distribution MAP)."""
    entry = F.struct("key", "messages")
    return distribution.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == "date", entry))).alias("date_distribution"),
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == "direction", entry))).alias(
            "direction_distribution"
        ),
    )


def _summary(rows: DataFrame, *extra) -> DataFrame:
    """Summary over the rows flagged ``_record`` (others only feed ``extra``)."""
    rec = F.col("_record")
    n = F.count_if(rec)
    total = F.sum(F.when(rec, F.col("avg_response_time")))
    first, last = F.min(F.when(rec, F.col("date"))), F.max(F.when(rec, F.col("date")))
    return rows.groupBy("user_id").agg(
        F.when(n > 0, ((2 * total + n - F.pmod(2 * total + n, 2 * n)) / (2 * n)).cast("long")).alias(
            "avg_response_time"
        ),
        F.min(F.when(rec, F.col("avg_response_time"))).alias("min_response_time"),
        F.max(F.when(rec, F.col("avg_response_time"))).alias("max_response_time"),
        n.alias("total_records"),
        # collect_set leaves NULL out; an absent number is a value of the list.
        F.concat(
            F.array_sort(F.collect_set(F.when(rec, F.col("phone_number")))),
            F.when(F.count_if(rec & F.col("phone_number").isNull()) > 0, F.array(F.lit(None).cast("string"))).otherwise(
                F.array().cast("array<string>")
            ),
        ).alias("phone_numbers"),
        F.when(n > 0, F.concat(first.cast("string"), F.lit(" to "), last.cast("string"))).alias("date_range"),
        *extra,
    )


def user_report(
    messages: DataFrame,
    hours_map: DataFrame,
    user_id: str | None = None,
    run_date: str | dt.date | None = None,
    days: int | None = 2,
) -> DataFrame:
    """One report row per user with messages in the window (all users when
    ``user_id`` is None).  Users without any kept reply get zeros and
    'No data', as the original summary did.

    The reply pairs flow through one linear chain (group aggregate -> phone
    collapse -> per-user aggregate), so the pairing LAG runs once; the
    statistics roll up from one grain of the messages."""
    msgs = user_messages(messages, user_id, run_date, days)
    stats = message_statistics(message_grain(msgs))
    groups = group_stats(adjusted_pairs(msgs, hours_map))
    kept = F.col("_n") > 0
    collapsed = last_chat_average(
        groups,
        F.count_if(kept).alias("_kept_groups"),
        F.sum("_pairs").alias("_pairs"),
        F.sum("_adjusted").alias("_adjusted"),
    )
    per_user = _summary(
        collapsed.select(
            "user_id", "phone_number", "date", "avg_response_time",
            (F.col("_kept_groups") > 0).alias("_record"), "_pairs", "_adjusted",
        ),
        F.sum("_pairs").alias("response_pairs"),
        F.sum("_adjusted").alias("hours_adjusted_pairs"),
    )
    report = stats.join(per_user, "user_id", "left")
    if user_id is not None:
        # A user without messages in the window gets a report of zeros.
        asked = messages.sparkSession.range(1).select(F.lit(str(user_id)).alias("user_id"))
        report = asked.join(report, "user_id", "left")
    zero = F.lit(0).cast("long")
    counts = ["message_count", "incoming_messages", "outgoing_messages", "unique_chats", "unique_phone_numbers",
              "conversation_groups"]
    return report.select(
        "user_id",
        *[F.coalesce(c, zero).alias(c) for c in counts],
        F.coalesce("response_pairs", zero).alias("response_pairs"),
        F.coalesce("hours_adjusted_pairs", zero).alias("hours_adjusted_pairs"),
        F.coalesce("total_records", zero).alias("total_records"),
        F.coalesce("avg_response_time", zero).alias("avg_response_time"),
        F.coalesce("min_response_time", zero).alias("min_response_time"),
        F.coalesce("max_response_time", zero).alias("max_response_time"),
        F.coalesce("phone_numbers", F.array().cast("array<string>")).alias("phone_numbers"),
        F.coalesce("date_range", F.lit("No data")).alias("date_range"),
    )


class RunCounters:
    """What one run of the response times counted, read after an action on its
    records: pairs, pairs adjusted by working hours, groups and records."""

    def __init__(self):
        self.pairs, self.groups, self.records = (Observation(f"{n}-{uuid.uuid4().hex}") for n in ("pairs", "groups", "records"))

    def read(self) -> dict[str, int]:
        found = {**self.pairs.get, **self.groups.get, **self.records.get}
        return {c: found.get(c, 0) for c in COUNTERS}


COUNTERS = ["response_pairs", "hours_adjusted_pairs", "conversation_groups", "total_records"]


def observed_response_times(messages: DataFrame, hours_map: DataFrame) -> tuple[DataFrame, RunCounters]:
    """Q3's records and the run's counters (A19), counted while the rows pass:
    no aggregate column and no further pass.  ``conversation_groups`` are the
    groups with a reply."""
    counters = RunCounters()
    pairs = adjusted_pairs(messages, hours_map)
    adjusted = F.col("has_hours") & F.col("response_ms").isNotNull()
    pairs = pairs.observe(
        counters.pairs,
        F.count(F.lit(1)).alias("response_pairs"),
        F.count_if(adjusted).alias("hours_adjusted_pairs"),
    )
    groups = group_stats(pairs).observe(counters.groups, F.count(F.lit(1)).alias("conversation_groups"))
    records = collapse_by_phone(groups.where(F.col("_n") > 0))
    return records.observe(counters.records, F.count(F.lit(1)).alias("total_records")), counters
