"""Derived fixtures reproduce the counts measured independently in
FIXTURES.md §4 (sf0.01)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MEDIUM
from parley.sources import fixtures, required, schemas


@pytest.fixture(scope="module")
def events(spark):
    return fixtures.load_table(spark, SF_MEDIUM, "events")


@pytest.fixture(scope="module")
def me(events):
    return fixtures.message_events(events)


def test_message_events_schema_and_required(me):
    schemas.assert_schema(me, schemas.MESSAGE_EVENTS)
    assert required.split_required(me, schemas.MESSAGE_EVENTS)[1] == {}


def test_counts(me, events):
    assert me.where("user_id IS NULL").count() == 984
    assert me.where("agent_phone_number IS NULL").count() == 787
    assert me.select("chat_id").distinct().count() == 100
    wh = fixtures.working_hours(events)
    assert wh.count() == 1426
    assert wh.select("user_id", "org_id").distinct().count() == 270


def test_pair_counts(me):
    """INCOMING -> OUTGOING pairs and follow-ups, lifetime (by chat) and daily
    (by user, chat), non-null users, ordered by time then event id."""
    lifetime = Window.partitionBy("chat_id").orderBy("message_timestamp", "event_id")
    ev = me.where("user_id IS NOT NULL").withColumn("pd", F.lag("direction").over(lifetime))
    assert ev.where("direction = 'OUTGOING' AND pd = 'INCOMING'").count() == 1386
    assert ev.where("direction = 'OUTGOING' AND pd = 'OUTGOING'").count() == 1448
    daily = Window.partitionBy("user_id", "chat_id").orderBy("message_timestamp", "event_id")
    ev = me.withColumn("pd", F.lag("direction").over(daily)).where("user_id IS NOT NULL")
    assert ev.where("direction = 'OUTGOING' AND pd = 'INCOMING'").count() == 1388
    assert ev.where("direction = 'OUTGOING' AND pd = 'OUTGOING'").count() == 1412


def test_mapping_and_config(spark, events):
    mapping = fixtures.user_mapping(events)
    assert mapping.where("row_order = 1").count() == mapping.where("user_id % 17 = 0").count() / 2
    config = fixtures.working_hours_config(mapping)
    kinds = {r.type: r.n for r in config.groupBy("type").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(kinds) == {"self", "team", "org"}
    assert config.where("week_day = 'monday,tuesday'").count() >= 1
    assert config.where("week_day = 'Friday'").count() >= 1


def test_conversation_turns(spark):
    """FIXTURES.md §3: at sf0.01, 100 conversations, 233 user->assistant
    pairs, no follow-ups, 24 system turns, (conv_id, turn) unique."""
    from parley.plans.response import response_pairs

    turns = fixtures.conversation_events(fixtures.load_table(spark, SF_MEDIUM, "conversations"))
    assert turns.select("chat_id").distinct().count() == 100
    assert turns.where("direction = 'SYSTEM'").count() == 24
    assert turns.select("event_id").distinct().count() == turns.count()
    w = Window.partitionBy("chat_id").orderBy("message_timestamp", "event_id")
    lagged = turns.withColumn("pd", F.lag("direction").over(w))
    assert lagged.where("direction = 'OUTGOING' AND pd = 'INCOMING'").count() == 233
    assert lagged.where("direction = 'OUTGOING' AND pd = 'OUTGOING'").count() == 0
    assert response_pairs(turns).count() <= 233
