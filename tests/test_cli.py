"""The command line runs the merge jobs on stored tables."""

import os
import tempfile

from conftest import SF_SMALL
from parley.__main__ import main
from parley.plans.jobs import read_table
from parley.sources import fixtures, schemas


def test_cli_jobs(spark):
    events = fixtures.load_table(spark, SF_SMALL, "events")
    root = tempfile.mkdtemp(prefix="parley-cli-")
    me_path, wh_path, cfg_path = (os.path.join(root, n) for n in ("message_events", "working_hours", "config"))
    fixtures.message_events(events).write.parquet(me_path)
    fixtures.working_hours(events).write.parquet(wh_path)
    fixtures.working_hours_config(fixtures.user_mapping(events)).write.parquet(cfg_path)

    summary = os.path.join(root, "summary")
    main(["conversation-summary", "--events", me_path, "--hours", wh_path, "--target", summary], spark)
    main(["conversation-summary", "--events", me_path, "--hours", wh_path, "--target", summary], spark)
    assert read_table(spark, summary, schemas.CONVERSATION_SUMMARY).count() == 51  # FIXTURES.md §4: lifetime groups at sf0.001

    daily = os.path.join(root, "daily")
    main(["daily-performance", "--events", me_path, "--hours", wh_path, "--target", daily, "--rejects", os.path.join(root, "rejects"),
          "--run-ts", "2024-01-31 00:00:00"], spark)
    assert read_table(spark, daily, schemas.DAILY_PERFORMANCE_SUMMARY, "activity_date").count() == 557  # FIXTURES.md §4: daily groups at sf0.001

    legacy = os.path.join(root, "legacy")
    main(["legacy", "--events", me_path, "--target", legacy, "--run-date", "2024-01-30",
          "--run-ts", "2024-01-30 12:00:00", "--variant", "enhanced", "--config", cfg_path], spark)
    assert read_table(spark, legacy, schemas.LEGACY_SUMMARY_FULL, "date").count() > 0
