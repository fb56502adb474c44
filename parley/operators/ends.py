"""First and last values of groups from fixed-width aggregation buffers.

``min_by``/``max_by`` over text has buffers of variable width, which Spark
aggregates by sorting all rows.  Here the value's code and its order travel
packed in one number, so the aggregation hashes:

* ``packed`` puts a small code behind an order number.  The least packed value
  gives the first order number and, among ties, the least code; packing the
  codes the other way round gives the greatest.  Where both agree the group is
  settled.
* Groups whose ties disagree, or whose value has no code, are *open*.  They
  are settled from their own rows in a second step (``settled``), which reads
  no row where no group is open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_code(value: Column, known: Sequence[str]) -> Column:
    """1, 2, ... for the known values, 0 for any other."""
    code = F.lit(0)
    for i, name in reversed(list(enumerate(known, 1))):
        code = F.when(value == name, F.lit(i)).otherwise(code)
    return code.cast("bigint")


def code_value(code: Column, known: Sequence[str]) -> Column:
    return F.get(F.array(F.lit(None).cast("string"), *[F.lit(k) for k in known]), code.cast("int"))


def packed(order: Column, code: Column, width: int) -> Column:
    """``order`` with a code below ``width`` behind it."""
    return order * width + code


def settled(
    groups: DataFrame, keys: Sequence[str], is_open: Column, rows: DataFrame, exact: dict[str, Column]
) -> DataFrame:
    """``groups`` with the columns of ``exact`` computed anew for the open ones:
    aggregates of their ``rows``, which have the same key columns.  The rows
    meet the open groups in a shuffle join, as these may grow with the data;
    where there is none, a test in the plan keeps every row back."""
    names = [f"_k{i}" for i in range(len(keys))]
    opened = groups.where(is_open)
    open_keys = opened.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])

    def same(left: DataFrame, right: DataFrame) -> Column:
        out = F.lit(True)
        for k, n in zip(keys, names, strict=True):
            out = out & left[k].eqNullSafe(right[n])
        return out

    needed = rows.where(opened.agg(F.count(F.lit(1))).scalar() > 0)
    again = needed.join(open_keys, same(needed, open_keys), "left_semi").groupBy(*keys)
    again = again.agg(*[c.alias(f"_x_{n}") for n, c in exact.items()])
    again = again.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], *[f"_x_{n}" for n in exact])
    mended = opened.join(again, same(opened, again)).select(
        *[F.col(f"_x_{c}").alias(c) if c in exact else F.col(c) for c in groups.columns]
    )
    return groups.where(~is_open).unionByName(mended)
