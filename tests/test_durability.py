"""Stored tables, restarts and configuration changes."""

import os

import pytest
from pyspark.sql import functions as F

from parley.functions.timecols import utc_date
from parley.operators.hours import weekly_slot_map
from parley.plans import jobs, merges
from parley.plans.report import user_report
from parley.session import ensure_checkpoint_dir
from parley.sources import schemas


def test_only_an_absent_table_is_empty(spark, tmp_path):
    absent = jobs.read_table(spark, str(tmp_path / "none"), schemas.CONVERSATION_SUMMARY)
    assert absent.count() == 0
    path = str(tmp_path / "other")
    spark.range(5).write.parquet(path)
    with pytest.raises(Exception, match="UNRESOLVED|cannot be resolved"):
        jobs.read_table(spark, path, schemas.CONVERSATION_SUMMARY).count()


def test_checkpoint_folder_is_set_once(spark):
    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first == ensure_checkpoint_dir(spark)


def test_stream_needs_a_checkpoint_location(spark):
    from parley.streaming.refresh import start_refresh

    with pytest.raises(TypeError):
        start_refresh(spark, "x", None, history_path="h", summary_path="s", daily_path="d")


def test_changed_files_are_seen(spark, tmp_path):
    """No relation is kept from one read to the next."""
    from parley.operators.joins import broadcast_if_small

    path = os.path.join(tmp_path, "hours")
    kept = set(spark.sparkContext._jsc.getPersistentRDDs())
    spark.range(3).write.parquet(path)
    assert broadcast_if_small(spark.read.parquet(path)).count() == 3
    spark.range(7).write.mode("overwrite").parquet(path)
    assert broadcast_if_small(spark.read.parquet(path)).count() == 7
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) == kept


def test_unreadable_clock_text_is_no_slot(spark):
    rows = [("u", "o", "monday", "bad", "18:00:00"), ("u", "o", "monday", "09:00:00", "18:00:00")]
    flat = spark.createDataFrame(rows, "user_id string, org_id string, week_day string, start_time string, end_time string")
    hours = weekly_slot_map(flat).first()["hours"]
    assert {k: (v["start_ms"], v["end_ms"]) for k, v in hours.items()} == {1: (9 * 3_600_000, 18 * 3_600_000)}


def test_non_numeric_org_fails_clearly(spark):
    source = spark.createDataFrame([], schemas.DAILY_PERFORMANCE_SUMMARY).withColumnRenamed("user_number", "agent_phone_number")
    row = spark.range(1).select(
        *[F.lit("org-x").alias(f.name) if f.name == "org_id" else F.lit(None).cast(f.dataType).alias(f.name)
          for f in source.schema.fields]
    )
    target = spark.createDataFrame([], schemas.DAILY_PERFORMANCE_SUMMARY)
    with pytest.raises(Exception, match="org_id is not a number: org-x"):
        merges.merge_daily_performance(target, row, "2024-01-01 00:00:00").collect()


@pytest.fixture(scope="module")
def text_id_messages(spark):
    rows = []
    for user, seconds in (("12", 120), ("12b", 1800), ("agent-7", 300)):
        rows.append((f"{user}-i", "c" + user, user, "INCOMING", "2024-01-10 10:00:00", "+1"))
        minutes, rest = divmod(seconds, 60)
        rows.append((f"{user}-o", "c" + user, user, "OUTGOING", f"2024-01-10 10:{minutes:02d}:{rest:02d}", None))
    df = spark.createDataFrame(rows, "event_id string, chat_id string, user_id string, direction string, t string, sender_number string")
    df = df.select("*", F.to_timestamp("t").alias("message_timestamp"), F.lit("1").alias("org_id"),
                   F.lit(None).cast("timestamp").alias("created_at"))
    have = {f.name for f in schemas.MESSAGE_EVENTS.fields}
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.MESSAGE_EVENTS.fields if f.name not in df.columns]
    return df.select(*[c for c in df.columns if c in have], *extra).withColumn("date", utc_date("message_timestamp"))


def test_report_keeps_text_ids_apart(spark, text_id_messages):
    hours = spark.createDataFrame(
        [], "user_id string, org_id string, hours map<int,struct<start_ms:bigint,end_ms:bigint>>, "
        "walk_prefix array<bigint>, next_offset array<int>"
    )
    got = {r["user_id"]: r for r in user_report(text_id_messages, hours, days=None).collect()}
    assert {u: (r["response_pairs"], r["avg_response_time"]) for u, r in got.items()} == {
        "12": (1, 120), "12b": (1, 1800), "agent-7": (1, 300)
    }
    assert got["12"]["phone_numbers"] == [None]
    nobody = user_report(text_id_messages, hours, user_id="nobody", days=None).collect()
    assert [(r["user_id"], r["message_count"], r["date_range"]) for r in nobody] == [("nobody", 0, "No data")]
