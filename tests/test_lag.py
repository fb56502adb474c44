"""The bucketed, stitched LAG equals a plain window LAG, including a key that
holds a third of all rows, NULL keys, empty buckets and timestamp ties."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import ts
from parley.operators.lag import lag_in_order

MINUTE_US = 60 * 10**6


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(7)
    base = ts("2024-01-01 00:00:00").timestamp()
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"k{rnd.randint(0, 40)}")
        sub = rnd.choice(["a", "b", None])
        # coarse timestamps (whole minutes over two days) produce ties
        t = base + 60 * rnd.randint(0, 2 * 24 * 60)
        rows.append((str(i), key, sub, dt.datetime.fromtimestamp(t, tz=dt.timezone.utc),
                     rnd.choice(["INCOMING", "OUTGOING", "SYSTEM"])))
    return spark.createDataFrame(rows, "event_id string, k string, s string, t timestamp, direction string")


@pytest.mark.parametrize(
    "bucket_us,hot_key_rows",
    [(None, 0), (7 * MINUTE_US, 0), (7 * MINUTE_US, 200), (3600 * 10**6, 0), (10 * 24 * 3600 * 10**6, 0),
     (3600 * 10**6, 10**9), (3600 * 10**6, 20)],
)
def test_matches_plain_window(events, bucket_us, hot_key_rows):
    """hot_key_rows=0 splits every key, 200 only the hot one, 10**9 none."""
    got = lag_in_order(events, ["k", "s"], ["t", "event_id"], ["direction", "t"], bucket_us=bucket_us,
                       hot_key_rows=hot_key_rows)
    w = Window.partitionBy("k", "s").orderBy("t", "event_id")
    want = events.select("*", F.lag("direction").over(w).alias("want_dir"), F.lag("t").over(w).alias("want_t"))
    joined = got.join(want.select("event_id", "want_dir", "want_t"), "event_id")
    bad = joined.where(
        ~F.col("prev_direction").eqNullSafe(F.col("want_dir")) | ~F.col("prev_t").eqNullSafe(F.col("want_t"))
    )
    assert joined.count() == events.count()
    assert bad.count() == 0


def test_order_key_follows_the_order(events):
    got = lag_in_order(events, ["k", "s"], ["t", "event_id"], ["direction"], bucket_us=7 * MINUTE_US, hot_key_rows=200)
    w = Window.partitionBy("k", "s").orderBy("t", "event_id")
    chk = got.select("k", "s", "order_key", F.lag("order_key").over(w).alias("prev_key"))
    assert chk.where(F.col("prev_key") >= F.col("order_key")).count() == 0


def test_long_history_hot_key(spark):
    """A hot key spanning years: bucket widths and order keys stay in range
    (ANSI arithmetic would fail on overflow) and the LAG is exact."""
    base = dt.datetime(2015, 1, 1, tzinfo=dt.timezone.utc).timestamp()
    rows = [(str(i), "hot", dt.datetime.fromtimestamp(base + i * 86_400 * 3.7, tz=dt.timezone.utc),
             "INCOMING" if i % 2 else "OUTGOING") for i in range(3000)]
    df = spark.createDataFrame(rows, "event_id string, k string, t timestamp, direction string")
    got = lag_in_order(df, ["k"], ["t", "event_id"], ["direction"], hot_key_rows=100)
    w = Window.partitionBy("k").orderBy("t", "event_id")
    want = df.select("event_id", F.lag("direction").over(w).alias("want"))
    bad = got.join(want, "event_id").where(~F.col("prev_direction").eqNullSafe(F.col("want")))
    assert bad.count() == 0


def test_bursts_of_a_hot_key_are_split(spark):
    """90 % of a hot key within one second: buckets stay near the target."""
    from pyspark.sql import Window

    target = 1000
    t = F.when(F.col("id") < 18_000, F.col("id") * 50).otherwise(F.col("id") * 3_600_000_000)
    df = spark.range(20_000).select(
        F.lit("hot").alias("k"),
        F.timestamp_micros(t.cast("long")).alias("t"),
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("direction"),
    )
    got = lag_in_order(df, ["k"], ["t", "event_id"], ["direction", "event_id"], hot_key_rows=target)
    buckets = got.groupBy((F.col("order_key") / F.lit(1 << 32)).cast("long").alias("b")).count().collect()
    assert len(buckets) >= 10 and max(r["count"] for r in buckets) <= 2 * target
    plain = F.lag("event_id").over(Window.partitionBy("k").orderBy("t", "event_id"))
    wrong = got.withColumn("want", plain).where(~F.col("want").eqNullSafe(F.col("prev_event_id"))).count()
    assert wrong == 0


def _buckets_and_errors(df, target):
    got = lag_in_order(df, ["k"], ["t", "event_id"], ["direction", "event_id"], hot_key_rows=target)
    buckets = got.groupBy((F.col("order_key") / F.lit(1 << 32)).cast("long").alias("b")).count().collect()
    plain = F.lag("event_id").over(Window.partitionBy("k").orderBy("t", "event_id"))
    wrong = got.withColumn("want", plain).where(~F.col("want").eqNullSafe(F.col("prev_event_id"))).count()
    return [r["count"] for r in buckets], wrong


@pytest.mark.parametrize("spread", [0, 1000], ids=["one microsecond", "over a minute"])
@pytest.mark.parametrize("target", [40, 5000])
def test_no_bucket_is_much_larger_than_asked(spark, spread, target):
    """60,000 rows of one key, also when all share one microsecond."""
    df = spark.range(60_000).select(
        F.lit("hot").alias("k"),
        F.timestamp_micros((F.lit(1_700_000_000_000_000) + F.col("id") * spread).cast("long")).alias("t"),
        F.lpad(F.col("id").cast("string"), 9, "0").alias("event_id"),
        F.lit("A").alias("direction"),
    )
    sizes, wrong = _buckets_and_errors(df, target)
    assert wrong == 0 and max(sizes) <= 2 * target and len(sizes) >= 60_000 / (2 * target)


def test_rows_equal_in_all_order_columns_stay_together(spark):
    df = spark.range(400).select(
        F.lit(None).cast("string").alias("k"), F.lit(None).cast("timestamp").alias("t"),
        (F.col("id") % 3).cast("string").alias("event_id"), F.lit("A").alias("direction"),
    )
    sizes, wrong = _buckets_and_errors(df, 10)
    assert wrong == 0 and len(sizes) == 3


def test_building_the_plan_starts_no_job(spark):
    import __spark_entry__ as entry

    spark.sparkContext.setJobGroup("plan-build", "none expected")
    try:
        for name in ("conversation_summary", "daily_performance", "user_report", "conversation_summary_upsert"):
            # Reading a Parquet footer may be a job; the tables' schemas are read here.
            entry.queries()[name](spark, "/root/testdata/sf0.001")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("plan-build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    reads = 2 * 4  # at most two tables per query
    assert len(jobs) <= reads
