"""Every registered query equals its DuckDB oracle (row count, column names
and an order-insensitive value hash) on the smallest data set, the way the
correctness gate compares them."""

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as entry
from scripts.compare import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(entry.core_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.core_queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
         "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(entry.core_queries()))
def test_query_types_match_oracle(spark, con, name):
    schema = {f.name: f.dataType.simpleString() for f in entry.queries()[name](spark, SF_SMALL).schema.fields}
    rel = con.sql(entry.oracle_sql()[name])
    oracle = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: _DUCK.get(t, t) for c, t in schema.items()} == oracle


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "average_response_time" in df.columns


NO_BROADCAST = {
    "parley.broadcast.maxBytes": "0",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.mark.parametrize("name", ["conversation_summary", "daily_performance", "adjusted_response_times",
                                  "legacy_enhanced_summary", "user_report"])
def test_shuffle_join_fallback_matches_oracle(spark, con, name):
    """When no relation is allowed to be broadcast (as when a dimension
    outgrows the bound), the shuffle-join plans give the same results."""
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    try:
        for k, v in NO_BROADCAST.items():
            spark.conf.set(k, v)
        df = entry.queries()[name](spark, SF_SMALL)
        rows = df.collect()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert digest(df.columns, rows)[0] == digest(ocols, cur.fetchall())[0]


@pytest.mark.parametrize("name", ["conversation_summary", "daily_performance", "adjusted_response_times",
                                  "conversation_turns_summary"])
def test_hot_key_path_matches_oracle(spark, con, name):
    """With every key treated as hot (split into hour buckets and stitched),
    the results are unchanged."""
    spark.conf.set("parley.lag.hotKeyRows", "0")
    try:
        df = entry.queries()[name](spark, SF_SMALL)
        rows = df.collect()
    finally:
        spark.conf.unset("parley.lag.hotKeyRows")
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert digest(df.columns, rows)[0] == digest(ocols, cur.fetchall())[0]
