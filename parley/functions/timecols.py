"""UTC calendar helpers as Column expressions.

Everything here is epoch arithmetic, so results never depend on
``spark.sql.session.timeZone`` and stay inside whole-stage codegen.
Integer division is written as ``(x - pmod(x, d)) / d`` cast to long, which is
exact (the numerator is a multiple of ``d``) and floors for negative epochs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_SEC = 1_000_000
US_PER_DAY = 86_400 * US_PER_SEC
MS_PER_DAY = 86_400_000
SEC_PER_DAY = 86_400

# Weekday names indexed 0 = Sunday .. 6 = Saturday (the order of
# a UTC getDay()), lower case as the configuration stores them.
WEEKDAY_NAMES = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def floor_div(x: Column, d: int) -> Column:
    """Exact floor division of a long column by a positive constant."""
    return ((x - F.pmod(x, F.lit(d))) / F.lit(d)).cast("long")


def instant_from_ntz(ts_ntz: Column | str) -> Column:
    """TIMESTAMP_NTZ wall-clock value read as a UTC instant (TIMESTAMP),
    independent of the session time zone."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts_ntz))
    return F.timestamp_micros(micros)


def epoch_us(ts: Column | str) -> Column:
    return F.unix_micros(_c(ts))


def epoch_ms(ts: Column | str) -> Column:
    """Milliseconds since the epoch, truncated (what a JS Date holds)."""
    return F.unix_millis(_c(ts))


def utc_unix_date(ts: Column | str) -> Column:
    """Days since 1970-01-01 of the UTC date of ``ts`` (long)."""
    return floor_div(epoch_us(ts), US_PER_DAY)


def utc_date(ts: Column | str) -> Column:
    """DATE(ts) in UTC."""
    return F.date_from_unix_date(utc_unix_date(ts).cast("int"))


def weekday0(ts: Column | str) -> Column:
    """UTC weekday, 0 = Sunday .. 6 = Saturday (1970-01-01 was a Thursday)."""
    return F.pmod(utc_unix_date(ts) + 4, F.lit(7)).cast("int")


def weekday1(ts: Column | str) -> Column:
    """UTC weekday, 1 = Sunday .. 7 = Saturday (warehouse DAYOFWEEK)."""
    return weekday0(ts) + 1


def time_of_day_us(ts: Column | str) -> Column:
    """TIME(ts) in UTC as microseconds since midnight."""
    return F.pmod(epoch_us(ts), F.lit(US_PER_DAY))


def weekday_name(weekday0_col: Column) -> Column:
    """Lower-case weekday name for a 0 = Sunday weekday index."""
    return F.get(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), weekday0_col)


def clock_us(text: Column | str, with_seconds: bool = True) -> Column:
    """'HH:MM[:SS]' text to microseconds since midnight.

    ``with_seconds=False`` reads hours and minutes only, as the message-level
    response-time rules do (seconds of the configuration are dropped)."""
    parts = F.split(_c(text), ":")
    h = F.get(parts, 0).try_cast("long")
    m = F.get(parts, 1).try_cast("long")
    secs = h * 3600 + F.coalesce(m, F.lit(0)) * 60
    if with_seconds:
        secs = secs + F.coalesce(F.get(parts, 2).try_cast("long"), F.lit(0))
    return secs * US_PER_SEC


def whole_seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` truncated toward zero (the
    warehouse TIMESTAMP_DIFF(end, start, SECOND))."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def round_half_up(x: Column) -> Column:
    """Half toward +infinity (JS Math.round); Spark's round() is half away
    from zero, which differs for negative halves."""
    return F.floor(x + F.lit(0.5))


def leading_int(x: Column | str) -> Column:
    """parseInt-like: the leading (optionally signed) digits as BIGINT, NULL
    when there are none (NaN matches nothing, and neither does NULL)."""
    digits = F.regexp_extract(_c(x).cast("string"), r"^\s*([+-]?[0-9]+)", 1)
    return digits.try_cast("long")


def utc_timestamp_literal(value) -> Column:
    """A TIMESTAMP literal for a UTC wall-clock value ('YYYY-MM-DD[ HH:MM:SS]'
    or a datetime; naive values are read as UTC), independent of the session
    time zone."""
    import datetime as dt

    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    micros = int(round(value.timestamp() * 1_000_000))
    return F.timestamp_micros(F.lit(micros))
