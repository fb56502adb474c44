"""The lookup join beyond the broadcast bound."""

import statistics

import pytest
from pyspark.sql import functions as F

from parley.operators.joins import lookup_join
from parley.operators.skew import HOT_KEY_CONF


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("parley.broadcast.maxBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set(HOT_KEY_CONF, "500")
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    spark.conf.unset("parley.broadcast.maxBytes")
    spark.conf.unset(HOT_KEY_CONF)


def test_hot_user_is_spread(shuffled):
    """A third of the rows belongs to one user, a fifth to none."""
    spark = shuffled
    i = F.col("id")
    user = F.when(i % 3 == 0, "hot").when(i % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("u"), (i % 997).cast("string")))
    events = spark.range(40_000).select(i.cast("string").alias("event_id"), user.alias("user_id"), F.lit("o").alias("org_id"))
    hours = spark.range(997).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"), F.lit("o").alias("org_id"),
                                    F.col("id").alias("slots"))
    hours = hours.unionByName(spark.createDataFrame([("hot", "o", -1)], "user_id string, org_id string, slots long"))
    got = lookup_join(events, hours, ["user_id", "org_id"], ["event_id"])
    assert "BroadcastHashJoin LeftOuter, BuildRight, [user_id" not in got._jdf.queryExecution().executedPlan().toString().replace("#", " ")
    want = events.join(hours, ["user_id", "org_id"], "left")
    assert got.count() == events.count()
    assert got.select("event_id", "slots").exceptAll(want.select("event_id", "slots")).count() == 0
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 4 and max(sizes) <= 2 * statistics.median(sizes)


def test_small_lookups_are_broadcast(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v long")
    lookup = spark.createDataFrame([("a", "x")], "k string, w string")
    got = lookup_join(rows, lookup, ["k"], ["v"])
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.v, r.w) for r in got.collect()) == [(1, "x"), (2, None), (3, None)]
