"""MERGE-style upsert for plain (non row-level) table formats.

``upsert`` returns the new snapshot of the target as a DataFrame: one full
outer join on the merge keys, then per column "updated / inserted / kept".
There is no delete clause.  As in MERGE, two source rows for one target key is
an error: the merge job fails with DUPLICATE_SOURCE_ROWS (the count per key is
computed inside the same job).

Keys compare null-safely by default (``null_safe=False`` gives plain
equality: a NULL key then never matches, so its source row is inserted again
and the old target row is kept).

``operators.snapshots`` stores the snapshots.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST


DUPLICATE_SOURCE_ROWS = "DUPLICATE_SOURCE_ROWS"
# Number of join partitions rows with a NULL plain-equality key are spread over.
NULL_KEY_SPREAD = 1024


def _relaxed(dtype: ST.DataType) -> ST.DataType:
    """``dtype`` with every nested field nullable (a full outer join makes
    any column nullable; Spark will not cast a nullable field to a
    non-nullable one)."""
    if isinstance(dtype, ST.StructType):
        return ST.StructType([ST.StructField(f.name, _relaxed(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, ST.ArrayType):
        return ST.ArrayType(_relaxed(dtype.elementType), True)
    if isinstance(dtype, ST.MapType):
        return ST.MapType(dtype.keyType, _relaxed(dtype.valueType), True)
    return dtype


def S(name: str) -> Column:
    """A source column inside update/insert expressions."""
    return F.col(f"__s.{name}")


def T(name: str) -> Column:
    """A target column inside update/insert expressions."""
    return F.col(f"__t.{name}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
    null_safe: bool | Sequence[str] = True,
    check_unique: bool = True,
) -> DataFrame:
    """MERGE INTO target USING source ON keys
    WHEN MATCHED THEN UPDATE SET ``update`` WHEN NOT MATCHED THEN INSERT ``insert``.

    ``keys`` lists key names shared by both sides, or maps target key ->
    source key.  ``update``/``insert`` map target column -> expression over
    ``S(...)``/``T(...)``; target columns missing from ``update`` keep their
    value, and missing from ``insert`` become NULL.  ``null_safe`` is a flag
    for all keys or the list of target keys compared null-safely.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    if isinstance(null_safe, bool):
        safe = set(pairs) if null_safe else set()
    else:
        safe = set(null_safe)
    s = source.withColumn("__s_present", F.lit(True))
    if check_unique:
        # MERGE fails when two source rows share a key.  The check runs inside
        # the merge job (a count per source key, then raise_error on the
        # output), so the source is not computed a second time.  Rows with a
        # NULL plain-equality key can never match and are not counted.
        plain = [sk for tk, sk in pairs.items() if tk not in safe]
        per_key = F.count(F.lit(1)).over(Window.partitionBy(*pairs.values()))
        matchable = F.lit(True)
        for k in plain:
            matchable = matchable & F.col(k).isNotNull()
        s = s.withColumn("__s_dups", F.when(matchable, per_key).otherwise(F.lit(1)))
    t = target.withColumn("__t_present", F.lit(True))
    conds = [
        (T(tk).eqNullSafe(S(sk)) if tk in safe else (T(tk) == S(sk))) for tk, sk in pairs.items()
    ]
    plain_t = [tk for tk in pairs if tk not in safe]
    if plain_t:
        # Rows with a NULL plain-equality key never match, yet a join would
        # hash all of them to one partition (a skewed task that AQE cannot
        # split in a full outer join).  A salt spreads them by a
        # deterministic row hash -- positive on the target side, negative on
        # the source side, 0 for matchable rows -- without changing matches.
        def salt(df: DataFrame, keys: list[str], sign: int) -> Column:
            unmatchable = F.lit(False)
            for k in keys:
                unmatchable = unmatchable | F.col(k).isNull()
            hashable = [c for c, dt in df.dtypes if not dt.startswith("map")]
            spread = F.pmod(F.xxhash64(*hashable), F.lit(NULL_KEY_SPREAD)) + 1
            return F.when(unmatchable, spread * sign).otherwise(F.lit(0).cast("long"))

        t = t.withColumn("__salt", salt(target, plain_t, 1))
        s = s.withColumn("__salt", salt(source, [pairs[k] for k in plain_t], -1))
        conds.append(T("__salt") == S("__salt"))
    t = t.alias("__t")
    s = s.alias("__s")
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    joined = t.join(s, cond, "full_outer")
    matched = F.col("__t.__t_present").isNotNull() & F.col("__s.__s_present").isNotNull()
    source_only = F.col("__t.__t_present").isNull()
    out = []
    for field in target.schema.fields:
        name = field.name
        upd = update.get(name, T(name))
        ins = insert.get(name, F.lit(None))
        out.append(
            F.when(matched, upd).when(source_only, ins).otherwise(T(name)).cast(_relaxed(field.dataType)).alias(name)
        )
    if check_unique:
        # A predicate, unlike an unused column, is never pruned.
        guard = F.when(
            F.col("__s.__s_dups") > 1,
            F.raise_error(F.lit(f"{DUPLICATE_SOURCE_ROWS}: MERGE keys {list(pairs)} match several source rows")),
        ).otherwise(F.lit(True))
        joined = joined.where(F.coalesce(guard, F.lit(True)))
    return joined.select(*out)
