"""Ties on message_timestamp are broken by event_id (compared as text),
consistently in LAG, first/last direction and follow-ups (T1)."""

from pyspark.sql import functions as F

from helpers import ts
from parley.plans import conversation, daily

COLS = ("event_id string, message_id string, chat_id string, org_id string, user_id string, "
        "message_timestamp timestamp, direction string, agent_phone_number string")


def _events(spark):
    t = ts("2024-01-01 10:00:00")
    rows = [
        # '10' sorts before '9' as text: OUTGOING first, then INCOMING, then OUTGOING
        ("9", "m1", "c1", "0", "u1", t, "INCOMING", "+1"),
        ("10", "m2", "c1", "0", "u1", t, "OUTGOING", "+1"),
        ("11", "m3", "c1", "0", "u1", ts("2024-01-01 10:01:00"), "OUTGOING", "+1"),
    ]
    return spark.createDataFrame(rows, COLS)


def _hours(spark):
    # Monday 09:00-18:00 for (u1, 0)
    return spark.createDataFrame([("u1", "0", 2, 9 * 3600 * 10**6, 18 * 3600 * 10**6)],
                                 "user_id string, org_id string, day_of_week int, start_us long, end_us long")


def test_lifetime_summary_ties(spark):
    for bucket in (None, 60 * 10**6):
        row = conversation.conversation_summary_flat(_events(spark), _hours(spark), bucket_us=bucket).first()
        assert row.conversation_starter == "employee"   # '10' (OUTGOING) is first
        assert row.last_message_from == "employee"
        # order: 10 OUT, 9 IN, 11 OUT -> one reply (9 -> 11, 60 s), no follow-up
        assert row.number_of_follow_ups == 0
        assert row.average_response_time == 60.0


def test_daily_summary_ties(spark):
    row = daily.daily_performance_flat(_events(spark), _hours(spark)).first()
    assert row.conversation_starter_of_day == "employee"
    assert row.avg_agent_response_time_seconds == 60.0
    # first contact (10:00:00) is not before the first agent message (10:00:00): no time to first response
    assert row.time_to_first_response_seconds is None
