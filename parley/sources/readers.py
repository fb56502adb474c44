"""Scans and sources (S1 - S8).

Sources are ordinary Spark reads.  A ``source`` argument may be a DataFrame
(already loaded), a table name, a Parquet path, or a JDBC spec
``{"url": ..., "dbtable": ..., **options}`` for the relational configuration.
Column pruning and filter pushdown are left to Catalyst: every reader returns a
lazy DataFrame and callers select what they need.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import utc_date, utc_unix_date
from . import schemas


def read_source(spark: SparkSession, source, schema=None) -> DataFrame:
    """DataFrame | table name | Parquet path | JDBC options mapping."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, Mapping):
        opts = dict(source)
        reader = spark.read.format("jdbc")
        for key, value in opts.items():
            reader = reader.option(key, value)
        return reader.load()
    if isinstance(source, str) and ("/" in source or source.endswith(".parquet")):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(source)
    return spark.table(source)


# S1 -------------------------------------------------------------------------
def read_message_events(spark: SparkSession, source) -> DataFrame:
    """Full scan of message_events (lifetime / all days)."""
    return read_source(spark, source, schemas.MESSAGE_EVENTS)


# S2 -------------------------------------------------------------------------
def ingestion_window(events: DataFrame, run_date: str | dt.date | None, days: int | None) -> DataFrame:
    """DATE(ingestion_timestamp) BETWEEN run_date - days AND run_date (UTC).

    ``days=None`` keeps all history.  Stored tables partitioned by an
    ``ingestion_date`` column get partition pruning from the same predicate;
    otherwise Parquet min/max statistics prune row groups."""
    if days is None:
        return events
    if run_date is None:
        raise ValueError("an ingestion window needs run_date (the reference's CURRENT_DATE, passed explicitly)")
    run = run_date if isinstance(run_date, dt.date) else dt.date.fromisoformat(str(run_date))
    lo = (run - dt.date(1970, 1, 1)).days - days
    hi = (run - dt.date(1970, 1, 1)).days
    if "ingestion_date" in events.columns:
        return events.where(F.col("ingestion_date").between(F.lit(run - dt.timedelta(days=days)), F.lit(run)))
    # Pushed to Parquet as a range on the raw timestamp.
    lo_ts = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=lo)
    hi_ts = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=hi + 1)
    ts = F.col("ingestion_timestamp")
    return events.where(
        (ts >= F.lit(lo_ts).cast("timestamp")) & (ts < F.lit(hi_ts).cast("timestamp"))
        & utc_unix_date(ts).between(lo, hi)
    )


# S3 / S4 --------------------------------------------------------------------
RESPONSE_COLUMNS = ["event_id", "user_id", "org_id", "chat_id", "sender_number", "direction", "message_timestamp"]


def read_messages(
    events: DataFrame,
    user_id: str | None = None,
    run_date: str | dt.date | None = None,
    days: int | None = 2,
    ordered: bool = True,
) -> DataFrame:
    """All columns of one user's (or every user's) messages in the ingestion
    window, ordered by user, org, chat, timestamp (event_id breaks ties)."""
    df = ingestion_window(events, run_date, days)
    if user_id is not None:
        df = df.where(F.col("user_id").cast("string") == F.lit(str(user_id)))
    if ordered:
        df = df.orderBy("user_id", "org_id", "chat_id", "message_timestamp", "event_id")
    return df


def project_messages(
    events: DataFrame,
    user_id: str | None = None,
    run_date: str | dt.date | None = None,
    days: int | None = 2,
) -> DataFrame:
    """The response-time projection: 7 columns + UTC ``date``."""
    df = read_messages(events, user_id, run_date, days, ordered=False).select(*RESPONSE_COLUMNS)
    return df.withColumn("date", utc_date("message_timestamp"))


# S5 -------------------------------------------------------------------------
def read_working_hours(spark: SparkSession, source) -> DataFrame:
    return read_source(spark, source, schemas.WORKING_HOURS)


# S6 / S7 --------------------------------------------------------------------
def read_working_hours_config(spark: SparkSession, source) -> DataFrame:
    """``SELECT * FROM working_hours`` of the relational store."""
    return read_source(spark, source, schemas.WORKING_HOURS_CONFIG)


def read_user_mapping(spark: SparkSession, source) -> DataFrame:
    """``SELECT user_id, team_id, org_id FROM user mappings`` (plus the
    fixture's ``row_order`` when present)."""
    df = read_source(spark, source)
    return df.select("user_id", "team_id", "org_id", *(["row_order"] if "row_order" in df.columns else []))


# S8 -------------------------------------------------------------------------
# The default calendar used when no configuration applies,
# monday..sunday 09:00:00-18:00:00, timezone offset 0.
DEFAULT_WEEK = [
    ("monday", "09:00:00", "18:00:00"),
    ("tuesday", "09:00:00", "18:00:00"),
    ("wednesday", "09:00:00", "18:00:00"),
    ("thursday", "09:00:00", "18:00:00"),
    ("friday", "09:00:00", "18:00:00"),
    ("saturday", "09:00:00", "18:00:00"),
    ("sunday", "09:00:00", "18:00:00"),
]


def default_week_column():
    """The default calendar as an ARRAY<STRUCT<week_day, start_time,
    end_time, timezone_offset>> literal (explode it; no join needed)."""
    return F.array(
        *[
            F.struct(
                F.lit(d).alias("week_day"),
                F.lit(s).alias("start_time"),
                F.lit(e).alias("end_time"),
                F.lit(0).alias("timezone_offset"),
            )
            for d, s, e in DEFAULT_WEEK
        ]
    )


def literal_hours(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """An inline relation of (week_day, start_time, end_time) rows."""
    return spark.createDataFrame(rows, "week_day string, start_time string, end_time string")

