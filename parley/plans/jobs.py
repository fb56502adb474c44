"""End-to-end merge jobs: read the sources, compute, upsert into the summary
table at ``target_path`` and write it back -- the work each original MERGE
statement did.

Targets are folders of ``operators.snapshots``; read them with ``read_table``.
The daily and legacy tables are partitioned by date and only the dates present
in the new rows are rewritten; the lifetime table is rewritten whole (use
``streaming.refresh`` for chat-bucketed incremental refreshes).  A table
switches to its new snapshot in one step, and every job is a deterministic
function of its inputs and ``run_ts``: a job that stops halfway leaves the old
snapshot, and running it again gives the same table.

Rows with a NULL in a REQUIRED column of the events are refused, or set aside
where the job is given a ``rejects`` folder (``sources.required``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.snapshots import read_snapshot, write_snapshot
from ..sources import schemas
from ..sources.required import checked
from . import conversation, daily, legacy, merges


def read_table(spark: SparkSession, path: str, schema, partition_by: str | None = None) -> DataFrame:
    """The table at ``path`` conformed to ``schema``; empty only when the path
    does not exist, an error when it cannot be read."""
    return read_snapshot(spark, path, schema, partition_by)


def _touched(target: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """Target rows in the partitions that ``rows`` will rewrite."""
    return target.join(rows.select(column).distinct(), column, "left_semi")


def conversation_summary_job(
    spark: SparkSession,
    events: DataFrame,
    working_hours: DataFrame,
    target_path: str,
    null_safe: bool = True,
    rejects: str | None = None,
) -> None:
    """M1: lifetime summary merged into ``target_path``."""
    events = checked(events, schemas.MESSAGE_EVENTS, rejects)
    target = read_table(spark, target_path, schemas.CONVERSATION_SUMMARY)
    merged = merges.merge_conversation_summary(
        target, conversation.conversation_summary(events, working_hours), null_safe
    )
    write_snapshot(merged, target_path)


def daily_performance_job(
    spark: SparkSession,
    events: DataFrame,
    working_hours: DataFrame,
    target_path: str,
    run_ts: str | dt.datetime,
    null_safe: bool = True,
    rejects: str | None = None,
) -> None:
    """M2: daily rows merged into the activity_date-partitioned table."""
    events = checked(events, schemas.MESSAGE_EVENTS, rejects)
    rows = daily.daily_performance(events, working_hours)
    target = _touched(read_table(spark, target_path, schemas.DAILY_PERFORMANCE_SUMMARY, "activity_date"), rows, "activity_date")
    merged = merges.merge_daily_performance(target, rows, run_ts, null_safe)
    write_snapshot(merged, target_path, partition_by="activity_date")


def legacy_summary_job(
    spark: SparkSession,
    events: DataFrame,
    target_path: str,
    run_date: str | dt.date,
    run_ts: str | dt.datetime,
    variant: str = "original",
    hours: DataFrame | None = None,
    days: int = 1,
    rejects: str | None = None,
) -> None:
    """M3 (``variant='original'``), M4 (``'simple'``) or M5 (``'enhanced'``,
    needs ``hours``) over the ingestion window, into the date-partitioned
    legacy table."""
    events = checked(events, schemas.MESSAGE_EVENTS, rejects)
    if variant == "original":
        rows = legacy.legacy_counts(events, run_date, days)
        target = read_table(spark, target_path, schemas.LEGACY_SUMMARY, "date")
        merge = merges.merge_legacy_counts
    else:
        if variant == "simple":
            rows = legacy.legacy_simple_summary(events, run_date, days)
        elif variant == "enhanced":
            if hours is None:
                raise ValueError("the enhanced summary needs a working-hours relation")
            rows = legacy.legacy_enhanced_summary(events, hours, run_date, days)
        else:
            raise ValueError(f"unknown variant {variant!r}")
        target = read_table(spark, target_path, schemas.LEGACY_SUMMARY_FULL, "date")
        merge = merges.merge_legacy_summary
    merged = merge(_touched(target, rows, "date"), rows, run_ts)
    write_snapshot(merged, target_path, partition_by="date")
