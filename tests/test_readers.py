import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from parley.sources import fixtures, readers, schemas


def test_sources_from_path_table_and_frame(spark):
    me = fixtures.message_events(fixtures.load_table(spark, SF_SMALL, "events"))
    path = os.path.join(tempfile.mkdtemp(prefix="parley-read-"), "message_events")
    me.write.parquet(path)
    from_path = readers.read_message_events(spark, path)
    schemas.assert_schema(from_path.select([f.name for f in schemas.MESSAGE_EVENTS.fields]).transform(
        lambda d: schemas.conform(d, schemas.MESSAGE_EVENTS)), schemas.MESSAGE_EVENTS)
    assert from_path.count() == me.count()
    me.createOrReplaceTempView("parley_me")
    assert readers.read_message_events(spark, "parley_me").count() == me.count()
    assert readers.read_source(spark, me) is me


def test_projected_and_ordered_reads(spark):
    me = fixtures.message_events(fixtures.load_table(spark, SF_SMALL, "events"))
    proj = readers.project_messages(me, user_id="7", run_date="2024-01-30", days=29)
    assert proj.columns == readers.RESPONSE_COLUMNS + ["date"]
    assert {r[0] for r in proj.select("user_id").distinct().collect()} <= {"7"}
    ordered = readers.read_messages(me, days=None).limit(50).collect()
    keys = [(r.user_id is not None, r.user_id, r.org_id, r.chat_id, r.message_timestamp) for r in ordered]
    assert [k[1:] for k in keys] == [k[1:] for k in sorted(keys, key=lambda k: (k[0], k[1] or "", k[2], k[3], k[4]))]


def test_default_week_literal(spark):
    rows = spark.range(1).select(F.explode(readers.default_week_column()).alias("d")).select("d.*").collect()
    assert [r.week_day for r in rows] == [d for d, _, _ in readers.DEFAULT_WEEK]
    assert {(r.start_time, r.end_time, r.timezone_offset) for r in rows} == {("09:00:00", "18:00:00", 0)}


def test_window_needs_a_run_date(spark):
    import pytest

    me = fixtures.message_events(fixtures.load_table(spark, SF_SMALL, "events"))
    with pytest.raises(ValueError, match="run_date"):
        readers.ingestion_window(me, None, 2)
