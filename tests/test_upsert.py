import datetime as dt

import pytest
from pyspark.sql import functions as F

from parley.operators.upsert import S, upsert
from parley.plans import merges

SCHEMA = "k string, p string, v long, created string, updated string"


def _merge(spark, target_rows, source_rows, null_safe=True):
    target = spark.createDataFrame(target_rows, SCHEMA)
    source = spark.createDataFrame(source_rows, "k string, p string, v long, at string")
    return upsert(
        target, source, ["k", "p"],
        update={"v": S("v"), "updated": S("at")},
        insert={"k": S("k"), "p": S("p"), "v": S("v"), "created": S("at"), "updated": S("at")},
        null_safe=null_safe,
    )


def test_update_insert_keep(spark):
    out = _merge(
        spark,
        [("a", "x", 1, "t0", "t0"), ("b", "x", 2, "t0", "t0")],
        [("a", "x", 10, "t1"), ("c", "y", 30, "t1")],
    )
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("a", "x", 10, "t0", "t1"), ("b", "x", 2, "t0", "t0"), ("c", "y", 30, "t1", "t1")]


def test_null_keys(spark):
    target = [("a", None, 1, "t0", "t0")]
    source = [("a", None, 5, "t1")]
    safe = sorted(tuple(r) for r in _merge(spark, target, source, null_safe=True).collect())
    plain = sorted(tuple(r) for r in _merge(spark, target, source, null_safe=False).collect())
    assert safe == [("a", None, 5, "t0", "t1")]
    # plain equality never matches NULL: the old row stays and the new one is inserted again
    assert plain == [("a", None, 1, "t0", "t0"), ("a", None, 5, "t1", "t1")]


def test_duplicate_source_rows_fail(spark):
    merged = _merge(spark, [("a", "x", 0, "t0", "t0")], [("a", "x", 1, "t1"), ("a", "x", 2, "t1")])
    with pytest.raises(Exception, match="DUPLICATE_SOURCE_ROWS"):
        merged.collect()
    # NULL keys under plain equality never match, so they are not duplicates
    ok = _merge(spark, [], [("a", None, 1, "t1"), ("a", None, 2, "t1")], null_safe=False)
    assert ok.count() == 2


def test_idempotent(spark):
    first = _merge(spark, [("a", "x", 1, "t0", "t0")], [("a", "x", 10, "t1"), ("c", "y", 30, "t1")])
    rows = [tuple(r) for r in first.collect()]
    source = [("a", "x", 10, "t1"), ("c", "y", 30, "t1")]
    second = _merge(spark, rows, source)
    assert sorted(tuple(r) for r in second.collect()) == sorted(rows)


def test_conversation_summary_merge_keeps_created_at(spark):
    from parley.sources import schemas

    analytics = (3, 2, 5, 4, 1)
    t0, t1, t2 = (dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in (1, 2, 3))
    row = ("u1", "0", "c1", None, analytics, 10.0, "contact", "employee", t1, t0)
    target = spark.createDataFrame([row], schemas.CONVERSATION_SUMMARY)
    newer = ("u1", "0", "c1", None, (4, 2, 6, 5, 1), 12.0, "contact", "contact", t2, t2)
    fresh = ("u2", "1", "c9", "+15", (1, 0, 1, 1, 0), 0.0, "employee", "employee", t2, t2)
    source = spark.createDataFrame([newer, fresh], schemas.CONVERSATION_SUMMARY)
    out = {r.uid: r for r in merges.merge_conversation_summary(target, source).collect()}
    assert out["u1"].created_at.date() == t0.date()
    assert out["u1"].updated_at.date() == t2.date()
    assert out["u1"].analytics.total_messages == 6 and out["u1"].last_message_from == "contact"
    assert out["u2"].created_at.date() == t2.date()
    # parity mode: NULL phone never matches, so the key is inserted again
    parity = merges.merge_conversation_summary(target, source, null_safe=False)
    assert parity.where(F.col("uid") == "u1").count() == 2


def test_legacy_merge_null_safe_phone_only(spark):
    from parley.sources import schemas

    d = dt.date(2024, 1, 29)
    t0 = dt.datetime(2024, 1, 29, tzinfo=dt.timezone.utc)
    target = spark.createDataFrame(
        [("u1", "0", d, None, (1, 1, 1), t0, t0), (None, "0", d, "+1", (1, 1, 1), t0, t0)], schemas.LEGACY_SUMMARY
    )
    counts = spark.createDataFrame(
        [("u1", "0", d, None, 5, 6, 7), (None, "0", d, "+1", 2, 2, 2)],
        "user_id string, org_id string, date date, sender_number string, total_sent long, "
        "total_received long, unique_messages long",
    )
    out = merges.merge_legacy_counts(target, counts, "2024-01-30 00:00:00").collect()
    # NULL phone matches (null-safe), NULL uid does not (plain equality): 3 rows
    assert len(out) == 3
    u1 = [r for r in out if r.uid == "u1"][0]
    assert tuple(u1.analytics) == (5, 6, 7)
