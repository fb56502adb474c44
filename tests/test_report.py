"""The report's grain adds up over batches; a run's counters are observed."""

from pyspark.sql import functions as F

from conftest import SF_MEDIUM
from parley.plans import config, report
from parley.sources import fixtures


def inputs(spark):
    events = fixtures.load_table(spark, SF_MEDIUM, "events")
    mapping = fixtures.user_mapping(events)
    hours = config.response_hours_map(mapping, fixtures.working_hours_config(mapping))
    return fixtures.message_events(events), hours


def test_counters_are_observed(spark):
    me, hours = inputs(spark)
    records, counters = report.observed_response_times(me, hours)
    n = len(records.collect())
    per_user = report.user_report(me, hours, days=None)
    sums = per_user.agg(*[F.sum(c).alias(c) for c in ("response_pairs", "hours_adjusted_pairs")]).first()
    everyone = report.adjusted_pairs(me, hours)
    unattributed = everyone.where("user_id IS NULL").count()
    got = counters.read()
    assert got["total_records"] == n
    assert got["response_pairs"] == sums["response_pairs"] + unattributed == everyone.count()
    assert got["hours_adjusted_pairs"] == sums["hours_adjusted_pairs"]


def test_grains_of_batches_add_up(spark):
    me, _ = inputs(spark)
    msgs = report.user_messages(me)
    early, late = msgs.where("date < DATE'2024-01-12'"), msgs.where("date >= DATE'2024-01-12'")
    parts = report.message_grain(early).unionByName(report.message_grain(late))
    added = parts.groupBy(*report.GRAIN).agg(F.sum("messages").alias("messages"))
    got, want = report.message_statistics(added), report.message_statistics(report.message_grain(msgs))
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count() > 0
    plain = msgs.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.count_distinct("chat_id").alias("unique_chats"),
        F.count_distinct("org_id", "chat_id", "date").alias("conversation_groups"),
        (F.count_distinct("sender_number") + F.max(F.col("sender_number").isNull().cast("long"))).alias("unique_phone_numbers"),
    )
    assert plain.exceptAll(want.select(plain.columns)).count() == 0
