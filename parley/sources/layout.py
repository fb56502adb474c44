"""Events stored in the order the conversation summaries read them.

``write_bucketed_events`` hashes the events into buckets by chat and sorts each
bucket by (chat, time, event id).  The LAG over a chat and the aggregations by
chat and more above it then run on the buckets as they are: the plans of Q1 and
of its upsert exchange no event rows.  The table carries the number of buckets,
so readers need no setting; choose it so that a bucket fits a task (events /
some 10 million).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 256
KEY, ORDER = "chat_id", ["chat_id", "message_timestamp", "event_id"]


def write_bucketed_events(events: DataFrame, table: str, path: str | None = None, buckets: int = BUCKETS) -> None:
    """Write ``events`` as the table ``table`` (its files at ``path``, or in the
    warehouse).  Rows are brought to their bucket first, so a bucket is about
    one file per task that holds some of it, not one per input task."""
    writer = events.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(*ORDER).mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def read_bucketed_events(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
