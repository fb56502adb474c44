"""Incremental refresh of the summary tables from a stream of new events.

The original refreshed its summaries by re-running a MERGE over recent
ingestion days or over all history.  Here each micro-batch of new message
events:

1. is appended to the event history, partitioned by chat bucket and the
   batch's epoch id with dynamic partition overwrite -- a retried epoch
   replaces its own partitions instead of duplicating rows;
2. extends the state of the chats it touches (``streaming.state``): their last
   events and mergeable sums, of the touched buckets only.  The history is read
   only for chats with an event at or before their last one (late or replayed),
   and only in the buckets of these;
3. upserts the summaries of the touched chats into the summary tables
   (``operators.upsert``), which switch to their new snapshots.

A retried batch finds its own events behind it and recomputes its chats from
the history, so re-running a batch after a failure gives the same tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.timecols import utc_date
from ..operators.snapshots import read_snapshot, write_snapshot
from ..plans import conversation, daily, merges
from ..sources import schemas
from . import state as summary_state
from .state import DAY, IDS, LIFE, STATE


CHAT_BUCKETS = 256


def chat_bucket(chat_id: Column | str = "chat_id", buckets: int = CHAT_BUCKETS) -> Column:
    """Stable hash bucket of a chat (the partition column of the history and
    of the lifetime summary table)."""
    col = F.col(chat_id) if isinstance(chat_id, str) else chat_id
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


SUMMARY = T.StructType([*schemas.CONVERSATION_SUMMARY.fields, T.StructField("chat_bucket", T.IntegerType())])


def read_summary(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """The lifetime summary a refresh keeps, of all or of some chat buckets."""
    return read_snapshot(spark, path, SUMMARY, "chat_bucket", buckets).drop("chat_bucket")


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The daily summary a refresh keeps."""
    return read_snapshot(spark, path, schemas.DAILY_PERFORMANCE_SUMMARY, "activity_date")


def _append(df: DataFrame, epoch_id: int, path: str) -> None:
    """Rows of one epoch, partitioned by bucket and epoch: a retried epoch
    replaces its own partitions."""
    (
        df.withColumn("epoch", F.lit(epoch_id).cast("long"))
        .hint("rebalance", "chat_bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("chat_bucket", "epoch")
        .parquet(path)
    )


def _history(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame:
    """The attributed events of some buckets; files replayed in another epoch
    are the same events."""
    return summary_state.attributed(spark.read.parquet(path).where(F.col("chat_bucket").isin(buckets)))


def _table_buckets(root: str, recorded: int, spark: SparkSession) -> int:
    """The number of buckets the tables were made with: the first batch's,
    stored with the state."""
    fields = T.StructType([T.StructField("buckets", T.IntegerType())])
    stored = read_snapshot(spark, f"{root}/layout", fields).first()
    if stored is None:
        write_snapshot(spark.createDataFrame([(recorded,)], fields).coalesce(1), f"{root}/layout")
        return recorded
    return stored["buckets"]


def refresh_batch(
    batch: DataFrame,
    epoch_id: int,
    *,
    history_path: str,
    summary_path: str,
    daily_path: str,
    state_path: str,
    working_hours: DataFrame,
    run_ts: str,
    buckets: int = CHAT_BUCKETS,
) -> None:
    """``foreachBatch`` body (see module doc).

    All tables but the daily one are partitioned by ``chat_bucket``; a batch
    reads and rewrites only the buckets of the chats it touches.  ``buckets``
    takes effect with the first batch and is then read from the state.  Lists
    of bucket ids in the driver are bounded by it."""
    spark = batch.sparkSession
    buckets = _table_buckets(state_path, buckets, spark)
    kept = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist())
        return kept[-1]

    batch = keep(batch.withColumn("chat_bucket", chat_bucket("chat_id", buckets)))
    try:
        _append(batch, epoch_id, history_path)
        events = keep(summary_state.attributed(batch))
        touched = [r[0] for r in events.select(chat_bucket("chat_id", buckets)).distinct().collect()]
        if not touched:
            return
        ids = summary_state.message_ids(events).withColumn("chat_bucket", chat_bucket("chat_id", buckets))
        _append(ids, epoch_id, f"{state_path}/ids")
        seen = spark.read.parquet(f"{state_path}/ids").where(F.col("chat_bucket").isin(touched) & (F.col("epoch") != epoch_id))
        state = read_snapshot(spark, f"{state_path}/state", STATE, "chat_bucket", touched)

        advances = {}
        for scope in (LIFE, DAY):
            late = keep(summary_state.late_partitions(events, state, scope))
            late_buckets = [r[0] for r in late.select(chat_bucket("chat_id", buckets)).distinct().collect()]
            history = _history(spark, history_path, late_buckets) if late_buckets else None
            advances[scope.name] = summary_state.advance(
                scope, events, state, seen.select(*IDS), late if late_buckets else None, history, working_hours
            )
        new_state = advances["life"].state.unionByName(advances["day"].state, allowMissingColumns=True)
        new_state = new_state.withColumn("chat_bucket", chat_bucket("chat_id", buckets))
        life, day = advances["life"].touched, advances["day"].touched
        write_snapshot(new_state.select(*STATE.fieldNames()), f"{state_path}/state", "chat_bucket")

        rows = conversation.summary_rows(summary_state.lifetime_aggregates(life))
        current = conversation.nest_analytics(rows, conversation.SUMMARY_COLUMNS)
        merged = merges.merge_conversation_summary(read_summary(spark, summary_path, touched), current)
        write_snapshot(merged.withColumn("chat_bucket", chat_bucket("chat_id", buckets)), summary_path, "chat_bucket")

        # Daily rows can change only on or after the earliest new message of each
        # (user, chat): earlier rows' LAG never looks forward.
        first_new = events.groupBy("user_id", F.col("chat_id").alias("contact_id")).agg(
            utc_date(F.min("message_timestamp")).alias("_from")
        )
        flat = daily.daily_rows(summary_state.daily_aggregates(day), working_hours)
        daily_rows = (
            conversation.nest_analytics(flat, daily.SUMMARY_SOURCE_COLUMNS)
            .join(first_new, ["user_id", "contact_id"])
            .where(F.col("activity_date") >= F.col("_from"))
            .drop("_from")
        )
        dates = daily_rows.select("activity_date").distinct()
        touched_days = read_daily(spark, daily_path).join(dates, "activity_date", "left_semi")
        merged_daily = merges.merge_daily_performance(touched_days, daily_rows, run_ts)
        # Only the touched activity_date partitions are rewritten.
        write_snapshot(merged_daily, daily_path, "activity_date")
    finally:
        for df in kept:
            df.unpersist()


def start_refresh(
    spark: SparkSession,
    events_dir: str,
    working_hours: DataFrame,
    *,
    history_path: str,
    summary_path: str,
    daily_path: str,
    state_path: str,
    checkpoint_location: str,
    run_ts: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Stream new Parquet event files from ``events_dir`` into the refresh.

    ``checkpoint_location`` must stay the same over restarts: it remembers the
    files already taken.  ``run_ts`` fixes the rows' time stamps (for tests);
    by default each epoch takes the time it runs at."""
    stream = spark.readStream.schema(schemas.MESSAGE_EVENTS).parquet(events_dir)
    writer = stream.writeStream.foreachBatch(
        lambda df, epoch: refresh_batch(
            df,
            epoch,
            history_path=history_path,
            summary_path=summary_path,
            daily_path=daily_path,
            state_path=state_path,
            working_hours=working_hours,
            run_ts=run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
        )
    ).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
