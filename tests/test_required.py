"""REQUIRED columns: a job refuses a NULL, or sets its rows aside."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from parley.plans import jobs
from parley.sources import fixtures, schemas
from parley.sources.required import RequiredColumnError, required_columns, split_required


@pytest.fixture(scope="module")
def loose(spark):
    events = fixtures.load_table(spark, SF_SMALL, "events")
    number = F.col("event_id").cast("long")
    me = fixtures.message_events(events).withColumns({
        "chat_id": F.when(number % 10 > 0, F.col("chat_id")),
        "direction": F.when(number % 15 > 0, F.col("direction")),
    })
    return me, fixtures.working_hours(events)


def wanted(me):
    return {c: me.where(F.col(c).isNull()).count() for c in ("chat_id", "direction")}


def test_split_counts_by_column_while_writing(spark, loose, tmp_path):
    me, _ = loose
    valid, counts = split_required(me, schemas.MESSAGE_EVENTS, str(tmp_path / "rejects"))
    assert counts == wanted(me) and min(counts.values()) > 0
    rejects = spark.read.parquet(str(tmp_path / "rejects") + "/*")
    both = rejects.where("size(all_violated) = 2").count()
    assert rejects.count() == sum(counts.values()) - both and both > 0
    assert valid.count() + rejects.count() == me.count()
    first = rejects.select("violated", F.col("all_violated")[0].alias("f"))
    assert first.where("violated <> f").count() == 0
    assert {r[0] for r in rejects.select("violated").distinct().collect()} == {"chat_id", "direction"}


def run(spark, job, me, wh, path, **kwargs):
    if job == "summary":
        jobs.conversation_summary_job(spark, me, wh, path, **kwargs)
        return jobs.read_table(spark, path, schemas.CONVERSATION_SUMMARY)
    if job == "daily":
        jobs.daily_performance_job(spark, me, wh, path, "2024-01-31 00:00:00", **kwargs)
        return jobs.read_table(spark, path, schemas.DAILY_PERFORMANCE_SUMMARY, "activity_date")
    jobs.legacy_summary_job(spark, me, path, "2024-01-30", "2024-01-31 00:00:00", days=30, **kwargs)
    return jobs.read_table(spark, path, schemas.LEGACY_SUMMARY, "date")


@pytest.mark.parametrize("job", ["summary", "daily", "legacy"])
def test_jobs_refuse_or_set_aside(spark, loose, tmp_path, job):
    me, wh = loose
    with pytest.raises(RequiredColumnError) as error:
        run(spark, job, me, wh, str(tmp_path / "refused"))
    assert error.value.counts == wanted(me)
    assert not (tmp_path / "refused").exists()
    valid = me.where("chat_id IS NOT NULL AND direction IS NOT NULL")
    got = run(spark, job, me, wh, str(tmp_path / "aside"), rejects=str(tmp_path / "rejects"))
    want = run(spark, job, valid, wh, str(tmp_path / "valid"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0


def test_nothing_to_check(spark):
    df = spark.createDataFrame([], schemas.MESSAGE_EVENTS)
    assert required_columns(df, schemas.MESSAGE_EVENTS) == []
    assert split_required(df, schemas.MESSAGE_EVENTS)[1] == {}
