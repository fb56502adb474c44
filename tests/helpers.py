"""Small helpers for literal-row tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

UTC = dt.timezone.utc


def ts(text: str) -> dt.datetime:
    """A UTC-aware datetime from 'YYYY-MM-DD HH:MM:SS[.ffffff]'."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def slot_map(slots: dict[int, tuple[str, str]]):
    """Literal weekly slot map {weekday0: ('HH:MM', 'HH:MM')} as a Column."""
    if not slots:
        return F.create_map().cast("map<int,struct<start_ms:bigint,end_ms:bigint>>")
    args = []
    for day, (start, end) in sorted(slots.items()):
        def ms(t):
            h, m = (int(x) for x in t.split(":")[:2])
            return (h * 3600 + m * 60) * 1000
        args += [F.lit(day), F.struct(F.lit(ms(start)).cast("long").alias("start_ms"),
                                      F.lit(ms(end)).cast("long").alias("end_ms"))]
    return F.create_map(*args)
