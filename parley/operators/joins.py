"""Size-checked broadcast and the lookup join beyond it.

A relation is hinted for broadcast only when the optimiser's size estimate
proves it small; anything else is joined by a shuffle, which adaptive execution
may still convert from measured sizes.  The estimate comes from the logical
plan's statistics: no job runs and nothing is cached, so a later read of
changed files sees the change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import PART_ROWS, ROWS, dealt, hot_keys, meet

DEFAULT_MAX_BYTES = 64 << 20
CONF_KEY = "parley.broadcast.maxBytes"
# Join partitions that rows with a NULL key are spread over.
NULL_PARTS = 1024
_SALT = "_lookup_salt"


def max_broadcast_bytes(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(CONF_KEY, None)
    return int(value) if value else DEFAULT_MAX_BYTES


def estimated_bytes(df: DataFrame) -> int:
    """The optimiser's size estimate of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    bound = max_bytes if max_bytes is not None else max_broadcast_bytes(df)
    return F.broadcast(df) if estimated_bytes(df) <= bound else df


def broadcast_if_few(df: DataFrame, source: DataFrame, width: int) -> DataFrame:
    """``df`` hinted for broadcast when ``source`` proves it small: ``df`` has at
    most one row per row of ``source``, at most ``width`` times as wide.  (The
    optimiser multiplies the sizes of joined relations, so its estimate of
    ``df`` itself says nothing.)"""
    return F.broadcast(df) if estimated_bytes(source) * width <= max_broadcast_bytes(df) else df


def is_hinted(df: DataFrame) -> bool:
    """Whether ``df`` carries a hint above its first join or union."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() != "ResolvedHint" and plan.children().size() == 1:
        plan = plan.children().head()
    return plan.nodeName() == "ResolvedHint"


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """``rows`` left-joined with ``lookup`` (one row per key) on ``keys``, plain
    equality.

    Within the broadcast bound (its own estimate, or a hint that it carries) the
    lookup is broadcast.  Beyond it both sides
    shuffle: the rows of a hot key are dealt over parts by a hash of their
    ``spread`` columns, and its lookup row is copied into each part, so no task
    gets all rows of one key; rows with a NULL key match nothing and are spread
    as well.  Copies of lookup rows number at most rows / rows-per-part.
    """
    if is_hinted(lookup) or estimated_bytes(lookup) <= max_broadcast_bytes(lookup):
        return rows.join(F.broadcast(lookup), list(keys), "left")
    parts = F.ceil(F.col(ROWS) / F.col(PART_ROWS)).cast("bigint").alias("_lookup_parts")
    hot = hot_keys(rows, keys).select(*keys, parts)
    unmatched = F.lit(False)
    for k in keys:
        unmatched = unmatched | F.col(k).isNull()
    salt = (
        F.when(unmatched, -1 - dealt(spread, F.lit(NULL_PARTS)))
        .when(F.col("_lookup_parts").isNotNull(), dealt(spread, F.col("_lookup_parts")))
        .otherwise(F.lit(0).cast("bigint"))
    )
    left = meet(rows, hot, keys, "left").withColumn(_SALT, salt).drop("_lookup_parts")
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_lookup_parts", F.lit(1)) - 1)
    right = meet(lookup, hot, keys, "left").withColumn(_SALT, F.explode(copies)).drop("_lookup_parts")
    return left.join(right, [*keys, _SALT], "left").drop(_SALT)
