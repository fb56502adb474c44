"""Hot keys, found inside the query that needs them.

A key is *hot* when it has more rows than a part may hold.  A part holds
``parley.lag.hotKeyRows`` rows (default 1,000,000), but never less than a
``MAX_PARTS``-th of the table: so there are at most ``MAX_PARTS`` hot keys and
twice as many parts, whatever the table's size, and lists of either may be
broadcast.  Counting is a branch of the same plan (a map-side partial count
over the key columns alone); no job runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_KEY_ROWS = 1_000_000
HOT_KEY_CONF = "parley.lag.hotKeyRows"
MAX_PARTS = 65_536
# Rows of a key, and rows of one of its parts.
ROWS, PART_ROWS = "_hot_n", "_hot_rows"


def part_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_KEY_CONF, None) or HOT_KEY_ROWS)


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """(keys, ROWS, PART_ROWS) of the hot keys of ``df``."""
    wanted = max(1, part_rows(df.sparkSession) if rows is None else rows)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))
    total = df.agg(F.count(F.lit(1))).scalar()
    per_part = F.greatest(F.lit(wanted), F.ceil(total / MAX_PARTS)).cast("bigint")
    return counts.select("*", per_part.alias(PART_ROWS)).where(F.col(ROWS) > F.col(PART_ROWS))


def meet(left: DataFrame, listed: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left`` joined with a bounded list on equal keys (NULL equals NULL), by
    broadcast; the list's other columns are added."""
    names = [f"_key{i}" for i in range(len(keys))]
    more = [c for c in listed.columns if c not in keys]
    named = listed.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], *more)
    condition = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        condition = condition & left[k].eqNullSafe(named[n])
    return left.join(F.broadcast(named), condition, how).drop(*names)


def dealt(columns: Sequence[Column | str], parts: Column) -> Column:
    """A part from 0 for a row, by a hash of its columns."""
    return F.pmod(F.xxhash64(*columns, F.lit("part")), parts).cast("bigint")
