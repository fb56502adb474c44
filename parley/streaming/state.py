"""State that lets a batch of new events extend the summaries.

One table, partitioned by chat bucket, holds two kinds of rows for each scope
(``life``: the LAG runs per chat; ``day``: per user and chat):

* *tails*: the last event of a LAG partition, all that the next event needs;
* *sums*: the aggregated rows of the summaries as sums that merge (counts, reply
  seconds, first and last event).  For days only the last date of a (user,
  chat) is kept: an event in order cannot reach an earlier one.

A batch whose events all lie behind their tail is put behind it: the tails are
the first rows of the LAG, and the sums of the batch are added.  Partitions with
an event at or before their tail (late, replayed, or a retried batch) are taken
from the history instead, which has the batch.  So applying a batch twice
changes nothing, and tails and sums switch together, being one table.

Distinct messages are counted against a table of the ids seen so far.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import utc_date
from ..operators.lag import lag_in_order
from ..plans.conversation import INCOMING, ORDER, OUTGOING, with_reply_seconds
from ..session import cut_lineage

SUMS = ["messages_received", "messages_sent", "number_of_follow_ups", "unique_messages", "_ws_n"]
STATE = T.StructType([
    T.StructField("scope", T.StringType()),
    T.StructField("is_tail", T.BooleanType()),
    *[T.StructField(c, T.StringType()) for c in ("chat_id", "user_id", "org_id", "agent_phone_number")],
    T.StructField("activity_date", T.DateType()),
    *[T.StructField(c, T.LongType()) for c in SUMS],
    T.StructField("_ws_sum", T.DoubleType()),
    T.StructField("first_ts", T.TimestampType()),
    T.StructField("first_id", T.StringType()),
    T.StructField("_first_out", T.IntegerType()),
    T.StructField("last_ts", T.TimestampType()),
    T.StructField("last_id", T.StringType()),
    T.StructField("_last_out", T.IntegerType()),
    T.StructField("last_direction", T.StringType()),
    T.StructField("_first_contact", T.TimestampType()),
    T.StructField("_first_agent", T.TimestampType()),
    T.StructField("chat_bucket", T.IntegerType()),
])
EVENT = ["event_id", "message_id", "chat_id", "user_id", "org_id", "agent_phone_number", "direction", "message_timestamp"]
IDS = ["chat_id", "user_id", "org_id", "agent_phone_number", "activity_date", "message_id"]


@dataclass(frozen=True)
class Scope:
    name: str
    tail_keys: tuple[str, ...]
    sum_keys: tuple[str, ...]


LIFE = Scope("life", ("chat_id",), ("chat_id", "user_id", "org_id", "agent_phone_number"))
DAY = Scope("day", ("user_id", "chat_id"), ("activity_date", "user_id", "org_id", "chat_id", "agent_phone_number"))


def attributed(events: DataFrame) -> DataFrame:
    """The events that count, each once."""
    return events.where(F.col("user_id").isNotNull()).select(*EVENT).dropDuplicates(["event_id"])


def message_ids(events: DataFrame) -> DataFrame:
    """The distinct message ids of attributed events, by summary key and date."""
    return events.withColumn("activity_date", utc_date("message_timestamp")).select(*IDS).distinct()


def _merged(sums: DataFrame, scope: Scope) -> DataFrame:
    """Sums of one key added up."""

    def at(end: str) -> Column:
        return F.when(F.col(f"{end}_ts").isNotNull(), F.struct(f"{end}_ts", f"{end}_id"))

    return sums.groupBy(*scope.sum_keys).agg(
        *[F.sum(c).alias(c) for c in (*SUMS, "_ws_sum")],
        F.min(at("first")).alias("_f"), F.min_by("_first_out", at("first")).alias("_first_out"),
        F.max(at("last")).alias("_l"), F.max_by("_last_out", at("last")).alias("_last_out"),
        F.min("_first_contact").alias("_first_contact"), F.min("_first_agent").alias("_first_agent"),
    ).select(
        *scope.sum_keys, *SUMS, "_ws_sum", F.col("_f.first_ts").alias("first_ts"), F.col("_f.first_id").alias("first_id"),
        "_first_out", F.col("_l.last_ts").alias("last_ts"), F.col("_l.last_id").alias("last_id"), "_last_out",
        "_first_contact", "_first_agent",
    )


def _event_sums(events: DataFrame, tails: DataFrame | None, ids: DataFrame, scope: Scope, hours: DataFrame) -> DataFrame:
    """Sums of events (behind their tails, if given); ``ids`` are the message
    ids to count."""
    rows = events.withColumn("_seed", F.lit(False))
    if tails is not None:
        seeds = tails.select(
            *[F.col(c) if c in scope.tail_keys else F.lit(None).cast("string").alias(c)
              for c in ("message_id", "chat_id", "user_id", "org_id", "agent_phone_number")],
            F.col("last_id").alias("event_id"), F.col("last_ts").alias("message_timestamp"),
            F.col("last_direction").alias("direction"), F.lit(True).alias("_seed"),
        )
        rows = rows.unionByName(seeds)
    rows = lag_in_order(rows, list(scope.tail_keys), ORDER, ["direction", "message_timestamp"]).where(~F.col("_seed"))
    is_in, is_out = F.col("direction") == INCOMING, F.col("direction") == OUTGOING
    rows = with_reply_seconds(rows, hours, is_out & (F.col("prev_direction") == INCOMING))
    rows = rows.withColumn("activity_date", utc_date("message_timestamp"))
    counted = F.when(F.col("working_seconds") > 0, F.col("working_seconds"))
    ts = F.col("message_timestamp")
    one = rows.select(
        *scope.sum_keys,
        is_in.cast("long").alias("messages_received"),
        is_out.cast("long").alias("messages_sent"),
        (is_out & F.coalesce(F.col("prev_direction") == OUTGOING, F.lit(False))).cast("long").alias("number_of_follow_ups"),
        F.lit(0).cast("long").alias("unique_messages"),
        counted.isNotNull().cast("long").alias("_ws_n"),
        counted.alias("_ws_sum"),
        ts.alias("first_ts"), F.col("event_id").alias("first_id"), is_out.cast("int").alias("_first_out"),
        ts.alias("last_ts"), F.col("event_id").alias("last_id"), is_out.cast("int").alias("_last_out"),
        F.when(is_in, ts).alias("_first_contact"), F.when(is_out, ts).alias("_first_agent"),
    )
    distinct = ids.select(*scope.sum_keys, "message_id").distinct().groupBy(*scope.sum_keys)
    unique = distinct.agg(F.count("message_id").alias("unique_messages"))
    return _merged(one.unionByName(unique, allowMissingColumns=True), scope)


@dataclass
class Advance:
    """What a batch makes of one scope: the scope's new rows of the state (all
    of the touched buckets), and the sums of the LAG partitions it touches."""

    state: DataFrame
    touched: DataFrame


def late_partitions(batch: DataFrame, state: DataFrame, scope: Scope) -> DataFrame:
    """The LAG partitions with an event of the batch at or before their tail."""
    tails = state.where((F.col("scope") == scope.name) & F.col("is_tail"))
    first = batch.groupBy(*scope.tail_keys).agg(
        F.min(F.struct(F.col("message_timestamp").alias("last_ts"), F.col("event_id").alias("last_id"))).alias("_lo")
    )
    met = first.join(tails.select(*scope.tail_keys, F.struct("last_ts", "last_id").alias("_tail")), list(scope.tail_keys))
    return met.where(F.col("_lo") <= F.col("_tail")).select(*scope.tail_keys)


def advance(
    scope: Scope, batch: DataFrame, state: DataFrame, seen: DataFrame, late: DataFrame | None, history: DataFrame | None,
    hours: DataFrame,
) -> Advance:
    """Apply an attributed ``batch`` to the ``state`` of its chat buckets.

    ``seen`` are the message ids of earlier batches; ``late`` the partitions
    to take from the attributed ``history`` (None: there are none, and no
    history is read)."""
    keys = list(scope.tail_keys)
    mine = state.where(F.col("scope") == scope.name)
    tails = mine.where("is_tail").select(*keys, "last_ts", "last_id", "last_direction")
    sums = mine.where("NOT is_tail").select(*scope.sum_keys, *_SUM_COLUMNS)
    touched_keys = batch.select(*keys).distinct()
    ordered, kept_sums = batch, sums
    if late is not None:
        ordered, kept_sums = batch.join(late, keys, "left_anti"), sums.join(late, keys, "left_anti")
    seeds = tails.join(ordered.select(*keys).distinct(), keys, "left_semi")
    ids = message_ids(ordered)
    id_keys = [*scope.sum_keys, "message_id"]
    known = seen.select(*[F.col(c).alias(f"_s_{c}") for c in id_keys])
    same = F.lit(True)
    for c in id_keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    fresh = _event_sums(ordered, seeds, ids.join(known, same, "left_anti"), scope, hours)
    merged = _merged(kept_sums.unionByName(fresh), scope)
    events = ordered
    if late is not None:
        again = history.join(late, keys, "left_semi")
        merged = merged.unionByName(_event_sums(again, None, message_ids(again), scope, hours))
        events = events.unionByName(again)
    # Both results come from these rows, which the history need not give twice.
    merged = cut_lineage(merged)
    ends = events.groupBy(*keys).agg(
        F.max(F.struct(F.col("message_timestamp").alias("last_ts"), F.col("event_id").alias("last_id"),
                       F.col("direction").alias("last_direction"))).alias("_end")
    ).select(*keys, "_end.*")
    new_tails = tails.join(touched_keys, keys, "left_anti").unionByName(ends)
    open_sums = merged
    if "activity_date" in scope.sum_keys:
        day = new_tails.select(*keys, utc_date("last_ts").alias("_day"))
        open_sums = merged.join(day, keys).where("activity_date = _day").drop("_day")
    rows = open_sums.withColumn("is_tail", F.lit(False)).unionByName(
        new_tails.withColumn("is_tail", F.lit(True)), allowMissingColumns=True
    )
    return Advance(rows.withColumn("scope", F.lit(scope.name)), merged.join(touched_keys, keys, "left_semi"))


_SUM_COLUMNS = [*SUMS, "_ws_sum", "first_ts", "first_id", "_first_out", "last_ts", "last_id", "_last_out",
                "_first_contact", "_first_agent"]


def lifetime_aggregates(sums: DataFrame) -> DataFrame:
    """Sums as ``plans.conversation.summary_rows`` takes them."""
    return sums.withColumnsRenamed({"first_ts": "created_at", "last_ts": "updated_at"})


def daily_aggregates(sums: DataFrame) -> DataFrame:
    """Sums as ``plans.daily.daily_rows`` takes them."""
    return sums.withColumnsRenamed({"messages_received": "contact_message_count", "messages_sent": "agent_message_count"})
