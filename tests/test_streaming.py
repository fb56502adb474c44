"""The streaming refresh, fed the events in two files, ends with the same
summary tables as one batch computation over all events."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from parley.functions.timecols import utc_timestamp_literal
from parley.plans import conversation, daily, merges
from parley.sources import fixtures
from parley.streaming.refresh import read_daily, read_summary, start_refresh
from scripts.compare import digest


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Small tables: most of a batch's time is its number of tasks and plans."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_refresh_matches_batch(spark):
    events = fixtures.load_table(spark, SF_SMALL, "events")
    me = fixtures.message_events(events)
    wh = fixtures.working_hours(events).persist()
    root = tempfile.mkdtemp(prefix="parley-stream-")
    src = os.path.join(root, "incoming")
    cut = utc_timestamp_literal("2024-01-20 00:00:00")
    me.where(F.col("message_timestamp") < cut).write.parquet(os.path.join(src, "part1"))
    paths = dict(
        history_path=os.path.join(root, "history"),
        summary_path=os.path.join(root, "summary"),
        daily_path=os.path.join(root, "daily"),
        state_path=os.path.join(root, "state"),
    )
    q = start_refresh(spark, os.path.join(src, "*"), wh, run_ts="2024-01-31 00:00:00",
                      checkpoint_location=os.path.join(root, "ckpt"), **paths)
    q.awaitTermination()
    me.where(F.col("message_timestamp") >= cut).write.parquet(os.path.join(src, "part2"))
    q = start_refresh(spark, os.path.join(src, "*"), wh, run_ts="2024-01-31 00:00:00",
                      checkpoint_location=os.path.join(root, "ckpt"), **paths)
    q.awaitTermination()

    got = merges.flatten_analytics(read_summary(spark, paths["summary_path"]))
    want = merges.flatten_analytics(conversation.conversation_summary(me, wh))
    cols = sorted(want.columns)
    assert digest(cols, got.select(cols).collect())[0] == digest(cols, want.select(cols).collect())[0]

    got_daily = read_daily(spark, paths["daily_path"]).drop("created_at", "updated_at")
    want_daily = merges.daily_target_rows(daily.daily_performance(me, wh), "2024-01-31").drop("created_at", "updated_at")
    cols = sorted(want_daily.columns)
    g = merges.flatten_analytics(got_daily.select(cols))
    w = merges.flatten_analytics(want_daily.select(cols))
    cols2 = sorted(w.columns)
    assert g.count() == w.count()
    assert digest(cols2, g.select(cols2).collect())[0] == digest(cols2, w.select(cols2).collect())[0]


def test_retried_epoch_is_idempotent(spark):
    from parley.streaming.refresh import refresh_batch

    events = fixtures.load_table(spark, SF_SMALL, "events")
    me = fixtures.message_events(events)
    wh = fixtures.working_hours(events).persist()
    root = tempfile.mkdtemp(prefix="parley-retry-")
    paths = dict(
        history_path=os.path.join(root, "history"),
        summary_path=os.path.join(root, "summary"),
        daily_path=os.path.join(root, "daily"),
        state_path=os.path.join(root, "state"),
    )
    batch = me.where(F.col("message_timestamp") < utc_timestamp_literal("2024-01-10 00:00:00"))
    refresh_batch(batch, 0, working_hours=wh, run_ts="2024-01-31 00:00:00", **paths)
    first = sorted(tuple(r) for r in read_summary(spark, paths["summary_path"]).drop("analytics").collect())
    n_hist = spark.read.parquet(paths["history_path"]).count()
    refresh_batch(batch, 0, working_hours=wh, run_ts="2024-01-31 00:00:00", **paths)
    again = sorted(tuple(r) for r in read_summary(spark, paths["summary_path"]).drop("analytics").collect())
    assert spark.read.parquet(paths["history_path"]).count() == n_hist == batch.count()
    assert again == first


@pytest.fixture(scope="module")
def inputs(spark):
    """The events of some chats."""
    events = fixtures.load_table(spark, SF_SMALL, "events")
    me = fixtures.message_events(events)
    return me.where("chat_id IN ('c0', 'c1', 'c4', 'c9', 'c12')"), fixtures.working_hours(events)


def same_tables(spark, me, wh, paths, *drop):
    """The kept tables equal a full recomputation."""
    got = merges.flatten_analytics(read_summary(spark, paths["summary_path"])).drop(*drop)
    want = merges.flatten_analytics(conversation.conversation_summary(me, wh)).select(got.columns)
    assert digest(got.columns, got.collect())[0] == digest(got.columns, want.collect())[0]
    got = merges.flatten_analytics(read_daily(spark, paths["daily_path"])).drop("created_at", "updated_at")
    want = merges.flatten_analytics(merges.daily_target_rows(daily.daily_performance(me, wh), "2024-01-31"))
    assert digest(got.columns, got.collect())[0] == digest(got.columns, want.select(got.columns).collect())[0]


def at(text):
    return utc_timestamp_literal(text)


def test_batches_in_order_read_no_history(spark, inputs, tmp_path, monkeypatch):
    """Two batches, cut within a day: state alone gives the full result."""
    from parley.streaming import refresh

    def forbidden(*_):
        raise AssertionError("history was read")

    monkeypatch.setattr(refresh, "_history", forbidden)
    me, wh = inputs
    paths = {f"{n}_path": str(tmp_path / n) for n in ("history", "summary", "daily", "state")}
    cuts = ["2023-01-01 00:00:00", "2024-01-10 11:30:00", "2025-01-01 00:00:00"]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        part = me.where((F.col("message_timestamp") >= at(a)) & (F.col("message_timestamp") < at(b)))
        refresh.refresh_batch(part, i, working_hours=wh, run_ts="2024-01-31 00:00:00", buckets=4, **paths)
    same_tables(spark, me, wh, paths)


def test_late_replayed_and_retried_events(spark, inputs, tmp_path):
    """Late events, events sent again and a batch applied twice; the number of
    buckets is the first batch's."""
    from parley.streaming import refresh

    me, wh = inputs
    paths = {f"{n}_path": str(tmp_path / n) for n in ("history", "summary", "daily", "state")}
    number = F.col("event_id").cast("long")
    run = lambda part, i, n: refresh.refresh_batch(
        part, i, working_hours=wh, run_ts="2024-01-31 00:00:00", buckets=n, **paths
    )
    early = F.col("message_timestamp") < at("2024-01-15 08:00:00")
    late = number % 40 == 7
    run(me.where(early & ~late), 0, 4)
    run(me.where(early & (number % 9 == 0)).unionByName(me.where(late & early)), 1, 16)
    run(me.where(early & (number % 9 == 0)).unionByName(me.where(late & early)), 1, 16)
    # The merge keeps created_at, also where an earlier event comes late.
    same_tables(spark, me.where(early), wh, paths, "created_at")
    assert {int(r[0]) for r in spark.read.parquet(paths["history_path"]).select("chat_bucket").distinct().collect()} <= set(range(4))


def test_files_read_are_those_of_touched_chats(spark, inputs, tmp_path):
    from parley.streaming import refresh

    me, wh = inputs
    paths = {f"{n}_path": str(tmp_path / n) for n in ("history", "summary", "daily", "state")}
    cut = F.col("message_timestamp") < at("2024-01-20 00:00:00")
    refresh.refresh_batch(me.where(cut), 0, working_hours=wh, run_ts="2024-01-31 00:00:00", buckets=8, **paths)
    chat = me.where(~cut).orderBy("event_id").first()["chat_id"]
    refresh.refresh_batch(me.where(~cut & (F.col("chat_id") == chat)), 1, working_hours=wh, run_ts="2024-01-31 00:00:00", **paths)
    for table in ("state/state", "summary"):
        versions = sorted(n for n in os.listdir(tmp_path / table) if n.startswith("snapshot_version="))
        parts = [n for n in os.listdir(tmp_path / table / versions[-1]) if n.startswith("chat_bucket=")]
        assert len(versions) == 2 and len(parts) == 1
    same_tables(spark, me.where(cut | (F.col("chat_id") == chat)), wh, paths)
