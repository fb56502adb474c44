"""Skew-safe ordered LAG.

A plain ``lag().over(Window.partitionBy(key))`` sends every row of a key to
one task; one very large chat would then be one task.  ``lag_in_order`` counts
rows per key in a branch of the same plan (a map-side partial count over the
key columns alone).  Keys with more rows than a bucket may hold are *hot* and
run apart from the others:

* A seeded sample of a hot key's rows (about ``SAMPLES`` per bucket, all rows
  where a bucket is smaller than that) is put in the full order, and every
  bucket's worth of samples gives a cut.  Cuts are values of all order columns,
  so rows of one microsecond are split as well; only rows that are equal in
  every order column stay together.
* The window runs per (key, bucket).  A cut is a row of the table, so a row
  that equals a cut also goes to the bucket before its own, where it comes last
  and meets its true predecessor; that copy is the one that stays.

All other keys run as one window partition each, by the plain key columns: an
aggregation by these columns (and more) above needs no further exchange.  Where
no key is hot, adaptive execution drops the hot branch before it reads
anything.  The result is always exactly the un-split LAG, and building the plan
starts no job.

Hot keys and their buckets are those of ``operators.skew``: at most
``MAX_PARTS`` keys and twice as many buckets, whatever the table's size, which
bounds the lists that are broadcast (hot keys and cuts).

The operator also emits ``order_key``: a BIGINT that grows along the window
order inside each key (bucket in the high bits, row number in the low 32).
Aggregations can then pick "first"/"last" rows with ``min_by``/``max_by`` over a
fixed-width key, which keeps them in hash aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import PART_ROWS, hot_keys, meet

HOUR_US = 3_600_000_000
# Sampled rows per bucket, and cuts that one step of the search looks at.
SAMPLES = 64
CUT_GROUP = 256

_B, _OWN, _CUTS, _AT = "_lag_b", "_lag_own", "_lag_cuts", "_lag_at"


def _cuts(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], hot: DataFrame) -> DataFrame:
    """(keys, cuts) of the hot keys: the first rows of all buckets but the
    first, in order, in groups of ``CUT_GROUP``."""
    rows = meet(df.select(*dict.fromkeys([*keys, *order_by])), hot, keys, "inner")
    per_bucket = F.least(F.col(PART_ROWS), F.lit(SAMPLES))
    # A row's hash decides, so equal rows are sampled alike.
    drawn = F.pmod(F.xxhash64(*order_by, F.lit("cut")), F.lit(1 << 30)) * F.col(PART_ROWS) < per_bucket * F.lit(1 << 30)
    # At most SAMPLES x MAX_PARTS sampled rows, of all keys together.
    in_order = Window.partitionBy(*keys).orderBy(*order_by)
    sampled = rows.where(drawn).withColumn(_AT, F.row_number().over(in_order) - 1)
    cut = sampled.where((F.col(_AT) > 0) & (F.col(_AT) % per_bucket == 0))
    # Cuts differ from each other, so that no bucket between two is empty.
    cut = cut.select(*keys, F.struct(*order_by).alias("_lag_c")).distinct()
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_lag_c")) - 1
    cut = cut.select(*keys, F.floor(number / CUT_GROUP).alias("_lag_g"), "_lag_c")
    grouped = cut.groupBy(*keys, "_lag_g").agg(F.array_sort(F.collect_list("_lag_c")).alias("_lag_c"))
    return grouped.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_lag_g", "_lag_c"))), lambda g: g["_lag_c"]).alias(_CUTS)
    )


def _bucket(row: Column) -> Column:
    """The number of cuts at or before a row, found group by group."""
    group = F.size(F.filter(_CUTS, lambda g: F.get(g, F.lit(0)) <= row))
    inside = F.size(F.filter(F.get(F.col(_CUTS), group - 1), lambda c: c <= row))
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * CUT_GROUP + inside).cast("bigint")


def _is_cut(row: Column) -> Column:
    """Whether the row equals the last cut before it."""
    at = (F.col(_OWN) - 1).cast("int")
    cut = F.get(F.get(F.col(_CUTS), F.floor(at / CUT_GROUP).cast("int")), at % CUT_GROUP)
    return (F.col(_OWN) > 0) & cut.eqNullSafe(row)


def lag_in_order(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    columns: Sequence[str],
    *,
    bucket_us: int | None = HOUR_US,
    hot_key_rows: int | None = None,
    prefix: str = "prev_",
    key_col: str = "order_key",
) -> DataFrame:
    """Add ``prefix + c`` (value of ``c`` on the previous row of the same
    partition in ``order_by`` order) for each of ``columns``, plus ``key_col``.

    ``order_by`` must be a total order.  ``bucket_us=None`` runs one plain
    window per partition, for inputs whose groups are known to be small; any
    other value lets hot keys be split.
    """

    keys = list(partition_by)

    def windowed(rows: DataFrame, *more: str) -> DataFrame:
        w = Window.partitionBy(*keys, *more).orderBy(*order_by)
        lags = [F.lag(c).over(w).alias(prefix + c) for c in columns]
        return rows.select("*", *lags, F.row_number().over(w).cast("long").alias(key_col))

    if bucket_us is None:
        return windowed(df)
    cuts = _cuts(df, keys, order_by, hot_keys(df, keys, hot_key_rows).select(*keys, PART_ROWS))
    cold = windowed(meet(df, cuts.select(*keys), keys, "left_anti"))
    row = F.struct(*order_by)
    hot = meet(df, cuts, keys, "inner").withColumn(_OWN, _bucket(row))
    own = F.col(_OWN)
    homes = F.when(_is_cut(row), F.array(own - 1, own)).otherwise(F.array(own))
    hot = windowed(hot.select(*df.columns, _OWN, _is_cut(row).alias(_AT), F.explode(homes).alias(_B)), _B)
    hot = hot.where(~F.col(_AT) | (F.col(_B) < own))
    return cold.unionByName(
        hot.select(*df.columns, *[prefix + c for c in columns], (F.col(_B) * F.lit(1 << 32) + F.col(key_col)).alias(key_col))
    )
