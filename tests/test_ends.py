"""First and last values from packed numbers equal the plain arg-min/max."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import ts
from parley.plans.legacy import KEYS, legacy_enhanced_summary
from parley.plans.response import RECORD, collapse_by_phone, group_stats

@pytest.fixture(scope="module")
def tied_events(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        rows.append((str(i), f"m{i}", rnd.choice(["u1", "u2", None]), rnd.choice(["0", None]), rnd.choice(["+1", "x", None]),
                     rnd.choice(["INCOMING", "OUTGOING", "SYSTEM", "odd", "other", None]),
                     ts(f"2024-01-0{rnd.randrange(1, 4)} 10:00:0{rnd.randrange(0, 3)}")))
    return spark.createDataFrame(
        rows, "event_id string, message_id string, user_id string, org_id string, sender_number string, direction string, "
        "message_timestamp timestamp"
    )


def test_enhanced_summary_settles_ties_and_unknown_directions(spark, tied_events):
    hours = spark.createDataFrame([("monday", "09:00:00", "18:00:00")], "week_day string, start_time string, end_time string")
    got = legacy_enhanced_summary(tied_events, hours, days=None)
    order = F.struct("message_timestamp", "event_id")
    want = tied_events.withColumn("date", F.to_date("message_timestamp")).groupBy(*KEYS).agg(
        F.min_by("direction", order).alias("s"), F.max_by("direction", order).alias("l"), F.count(F.lit(1)).alias("n")
    )
    joined = got.join(want, [got[k].eqNullSafe(want[k]) for k in KEYS])
    assert joined.count() == got.count() == want.count()
    assert joined.where(
        "NOT (conversation_starter <=> s) OR NOT (last_message_from <=> l) OR total_messages <> n"
    ).count() == 0


def test_sender_and_last_chat(spark):
    """The first kept reply's sender, an absent one included, and the last chat."""
    rnd = random.Random(9)
    rows = []
    for i in range(500):
        chat = rnd.choice(["c1", "c2", "chat-with-a-long-name-1", "chat-with-a-long-name-2", "chat-with-a-long-name-3"])
        rows.append((rnd.choice(["1", "2"]), "0", chat, rnd.choice(["d1", "d2"]), rnd.choice(["+1", "agent x", None]), i,
                     rnd.choice([None, rnd.randrange(0, 90_000_000)])))
    pairs = spark.createDataFrame(
        rows, "user_id string, org_id string, chat_id string, date string, sender_number string, order_key long, response_ms long"
    )
    groups = group_stats(pairs)
    first = F.when(F.col("response_ms").isNotNull(), F.col("order_key"))
    want = pairs.groupBy("user_id", "org_id", "chat_id", "date").agg(F.min_by("sender_number", first).alias("p"))
    keys = ["user_id", "org_id", "chat_id", "date"]
    assert groups.join(want, keys).where("NOT (phone_number <=> p)").count() == 0 and groups.count() == want.count()
    kept = groups.where("_n > 0")
    got = collapse_by_phone(kept)
    last = kept.groupBy(*RECORD).agg(F.max_by("avg_response_time", "chat_id").alias("avg_response_time"))
    last = last.withColumns({"user_id": F.col("user_id").cast("long"), "org_id": F.col("org_id").cast("long")})
    assert got.exceptAll(last.select(got.columns)).count() == 0 and got.count() == last.count()
