"""

Every registered query reads the driver's parquet tables in ``sf_dir`` (or
relations Spark derives from them with the FIXTURES.md rules) and runs over
the whole tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import NOBODY, ONE_CALENDAR, ONE_USER, ORACLES  # noqa: E402
from parley.functions.timecols import utc_timestamp_literal  # noqa: E402
from parley.plans import config, conversation, daily, legacy, merges, reads, report, response  # noqa: E402
from parley.sources import fixtures, readers, required, schemas  # noqa: E402

# The training-data operators are an optional part: without their files the
# other queries still work.
try:
    import corpus_pipeline  # noqa: E402
    from parley.llm import queries as llm_queries  # noqa: E402
except ImportError:
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# The upsert checks start from the snapshot a run before CUTOFF produced
# (run at RUN_TS_PREV) and merge a full run (at RUN_TS) into it.
CUTOFF = "2024-01-20 00:00:00"
RUN_TS_PREV = "2024-01-20 00:00:00"
RUN_TS = "2024-01-31 00:00:00"


class Inputs:
    """The inputs of one query, each table read once.  Building them starts
    no job and keeps nothing for the next query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return fixtures.load_table(self.spark, self.sf_dir, "events")

    @cached_property
    def message_events(self) -> DataFrame:
        return fixtures.message_events(self.events)

    @cached_property
    def working_hours(self) -> DataFrame:
        return fixtures.working_hours(self.events)

    @cached_property
    def mapping(self) -> DataFrame:
        return fixtures.user_mapping(self.events)

    @cached_property
    def config(self) -> DataFrame:
        return fixtures.working_hours_config(self.mapping)

    @cached_property
    def response_hours(self) -> DataFrame:
        return config.response_hours_map(self.mapping, self.config)

    @cached_property
    def turn_events(self) -> DataFrame:
        return fixtures.conversation_events(fixtures.load_table(self.spark, self.sf_dir, "conversations"))

    def message_users(self) -> DataFrame:
        """Distinct (user_id, org_id) of attributed messages."""
        return self.message_events.where("user_id IS NOT NULL").select("user_id", "org_id").distinct()

    def before_cutoff(self) -> DataFrame:
        return self.message_events.where(F.col("message_timestamp") < utc_timestamp_literal(CUTOFF))


def q_conversation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return conversation.conversation_summary_flat(i.message_events, i.working_hours)


def q_daily_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return daily.daily_performance_flat(i.message_events, i.working_hours)


def q_adjusted_response_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return response.adjusted_response_times(i.message_events, i.response_hours)


def q_raw_response_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return response.raw_response_times(Inputs(spark, sf_dir).message_events)


def q_user_working_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return config.user_working_hours(i.mapping, i.config)


def q_user_working_hours_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return config.user_working_hours_flat(i.mapping, i.config)


def q_working_hours_for_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return config.working_hours_for(i.config, i.message_users())


def q_weekday_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.weekday_pivot(Inputs(spark, sf_dir).working_hours)


def q_conversation_summary_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    previous = conversation.conversation_summary(i.before_cutoff(), i.working_hours)
    current = conversation.conversation_summary(i.message_events, i.working_hours)
    return merges.flatten_analytics(merges.merge_conversation_summary(previous, current))


def q_daily_performance_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    previous = merges.daily_target_rows(daily.daily_performance(i.before_cutoff(), i.working_hours), RUN_TS_PREV)
    current = daily.daily_performance(i.message_events, i.working_hours)
    return merges.flatten_analytics(merges.merge_daily_performance(previous, current, RUN_TS))


def q_legacy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.legacy_counts(Inputs(spark, sf_dir).message_events, days=None)


def q_legacy_counts_last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original merge's default window: ingestion date in [run_date - 1, run_date]."""
    return legacy.legacy_counts(Inputs(spark, sf_dir).message_events, run_date="2024-01-30", days=1)


def q_legacy_simple_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.legacy_simple_summary(Inputs(spark, sf_dir).message_events, days=None)


def q_legacy_enhanced_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    hours = config.working_hours_for(i.config, i.message_users())
    return legacy.legacy_enhanced_summary(i.message_events, hours, days=None)


def q_legacy_counts_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    previous = merges.legacy_counts_rows(legacy.legacy_counts(i.before_cutoff(), days=None), RUN_TS_PREV)
    current = legacy.legacy_counts(i.message_events, days=None)
    return merges.flatten_analytics(merges.merge_legacy_counts(previous, current, RUN_TS))


def q_legacy_summary_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    previous = merges.legacy_summary_rows(legacy.legacy_simple_summary(i.before_cutoff(), days=None), RUN_TS_PREV)
    current = legacy.legacy_simple_summary(i.message_events, days=None)
    return merges.flatten_analytics(merges.merge_legacy_summary(previous, current, RUN_TS))


def q_user_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return _report_rows(report.user_report(i.message_events, i.response_hours, days=None))


def q_message_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = report.user_messages(Inputs(spark, sf_dir).message_events)
    return report.message_distribution(msgs)


def q_ordered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.ordered_messages(Inputs(spark, sf_dir).message_events, days=None)


def q_next_working_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return reads.next_working_periods(i.message_events, i.response_hours)


def q_conversation_turns_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return conversation.conversation_summary_flat(i.turn_events, i.working_hours)


def q_conversation_turns_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return daily.daily_performance_flat(i.turn_events, i.working_hours)


def q_conversation_turns_response_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return response.raw_response_times(Inputs(spark, sf_dir).turn_events)


def q_working_seconds_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return conversation.function_working_seconds(i.message_events, i.working_hours)


def q_lifetime_response_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return response.lifetime_response_pairs(i.message_events, i.response_hours)


def _report_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("phone_numbers", F.concat_ws(",", "phone_numbers"))


def q_user_report_one_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user's report, and that of a user without messages."""
    i = Inputs(spark, sf_dir)
    one, nobody = (report.user_report(i.message_events, i.response_hours, user_id=u, days=None) for u in (ONE_USER, NOBODY))
    return _report_rows(one.unionByName(nobody))


def q_user_report_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report where a letter tells two users of one number apart."""
    i = Inputs(spark, sf_dir)
    odd = F.col("event_id").cast("long") % 2 == 1
    named = i.message_events.withColumn("user_id", F.when(odd, F.concat("user_id", F.lit("b"))).otherwise(F.col("user_id")))
    return _report_rows(report.user_report(named, i.response_hours, days=None))


def q_message_distribution_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distribution maps, as sorted key=count lists."""
    maps = report.distribution_maps(q_message_distribution(spark, sf_dir))

    def listed(name: str):
        entries = F.transform(F.map_entries(name), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
        return F.array_join(F.array_sort(entries), ",").alias(name)

    return maps.select("user_id", listed("date_distribution"), listed("direction_distribution"))


def q_response_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all users, and what it counted while its records passed."""
    i = Inputs(spark, sf_dir)
    records, counters = report.observed_response_times(i.message_events, i.response_hours)
    records.write.format("noop").mode("overwrite").save()
    found = counters.read()
    return spark.range(1).select(*[F.lit(found[c]).cast("long").alias(c) for c in report.COUNTERS])


def q_messages_last_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.ordered_messages(Inputs(spark, sf_dir).message_events, run_date="2024-01-30", days=2)


def q_one_user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Inputs(spark, sf_dir).message_events
    return reads.ordered_messages(events, user_id=ONE_USER, run_date="2024-01-30", days=2)


def q_configured_user_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return config.configured_user_count(i.mapping, i.config)


def q_required_column_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a job sets aside, of events that lost some chats and directions."""
    event = F.col("event_id").cast("long")
    loose = Inputs(spark, sf_dir).message_events.withColumns({
        "chat_id": F.when(event % 97 != 0, F.col("chat_id")),
        "direction": F.when(event % 89 != 0, F.col("direction")),
    })
    bad, _, _ = required.violations(loose, schemas.MESSAGE_EVENTS)
    return bad.select("event_id", "violated", F.array_join("all_violated", ",").alias("all_violated"))


def q_legacy_enhanced_one_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One literal calendar applied to every message."""
    hours = readers.literal_hours(spark, ONE_CALENDAR)
    return legacy.legacy_enhanced_summary(Inputs(spark, sf_dir).message_events, hours, days=None)


def q_legacy_enhanced_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    hours = config.working_hours_for(i.config, i.message_users())
    previous = merges.legacy_summary_rows(legacy.legacy_enhanced_summary(i.before_cutoff(), hours, days=None), RUN_TS_PREV)
    current = legacy.legacy_enhanced_summary(i.message_events, hours, days=None)
    return merges.flatten_analytics(merges.merge_legacy_summary(previous, current, RUN_TS))


def q_conversation_summary_upsert_plain_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only later messages are merged, with plain equality of all keys: rows of
    the target alone stay, and rows with a NULL key are inserted again."""
    i = Inputs(spark, sf_dir)
    late = i.message_events.where(F.col("message_timestamp") >= utc_timestamp_literal(CUTOFF))
    previous = conversation.conversation_summary(i.before_cutoff(), i.working_hours)
    current = conversation.conversation_summary(late, i.working_hours)
    return merges.flatten_analytics(merges.merge_conversation_summary(previous, current, null_safe=False))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the lifetime conversation summary on sf0.001."""
    return q_conversation_summary(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """
    compose); each takes (spark, sf_dir)."""
    return {
        **core_queries(),
        **({**llm_queries.queries(), "pipeline": corpus_pipeline.run} if llm_queries else {}),
    }


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of the conversation analytics."""
    return {
        "conversation_summary": q_conversation_summary,
        "daily_performance": q_daily_performance,
        "adjusted_response_times": q_adjusted_response_times,
        "raw_response_times": q_raw_response_times,
        "user_working_hours": q_user_working_hours,
        "user_working_hours_flat": q_user_working_hours_flat,
        "working_hours_for_users": q_working_hours_for_users,
        "weekday_pivot": q_weekday_pivot,
        "conversation_summary_upsert": q_conversation_summary_upsert,
        "daily_performance_upsert": q_daily_performance_upsert,
        "legacy_counts": q_legacy_counts,
        "legacy_counts_last_day": q_legacy_counts_last_day,
        "legacy_simple_summary": q_legacy_simple_summary,
        "legacy_enhanced_summary": q_legacy_enhanced_summary,
        "legacy_counts_upsert": q_legacy_counts_upsert,
        "legacy_summary_upsert": q_legacy_summary_upsert,
        "user_report": q_user_report,
        "message_distribution": q_message_distribution,
        "ordered_messages": q_ordered_messages,
        "next_working_periods": q_next_working_periods,
        "conversation_turns_summary": q_conversation_turns_summary,
        "conversation_turns_daily": q_conversation_turns_daily,
        "conversation_turns_response_times": q_conversation_turns_response_times,
        "working_seconds_function": q_working_seconds_function,
        "lifetime_response_pairs": q_lifetime_response_pairs,
        "user_report_one_user": q_user_report_one_user,
        "user_report_text_ids": q_user_report_text_ids,
        "message_distribution_maps": q_message_distribution_maps,
        "response_run_counters": q_response_run_counters,
        "messages_last_two_days": q_messages_last_two_days,
        "one_user_messages": q_one_user_messages,
        "configured_user_count": q_configured_user_count,
        "required_column_violations": q_required_column_violations,
        "legacy_enhanced_one_calendar": q_legacy_enhanced_one_calendar,
        "legacy_enhanced_upsert": q_legacy_enhanced_upsert,
        "conversation_summary_upsert_plain_keys": q_conversation_summary_upsert_plain_keys,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the registered queries that SQL can express (see
    ``oracle.py`` and ``parley.llm.oracles``)."""
    sql = {**ORACLES, **(llm_queries.oracle_sql() if llm_queries else {})}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {name: text for name, text in sql.items() if name in queries()}
