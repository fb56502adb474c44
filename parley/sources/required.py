"""REQUIRED columns (S9): refuse or set aside rows that hold a NULL in one.

The check is one pass over the rows that violate: the filter is a disjunction
of IS NULL tests on the scan's own columns, so Parquet skips every row group
whose statistics count no NULL.  The violations are counted by column while
the rows pass (``DataFrame.observe``), not by a job of their own.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


class RequiredColumnError(ValueError):
    """Rows hold a NULL in a REQUIRED column; ``counts`` has the rows by
    column."""

    def __init__(self, counts: dict[str, int]):
        super().__init__("NULL in REQUIRED columns: " + ", ".join(f"{c} ({n} rows)" for c, n in counts.items()))
        self.counts = counts


def required_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """REQUIRED columns of the schema that ``df`` has and may hold NULLs in."""
    nullable = {f.name for f in df.schema.fields if f.nullable}
    return [f.name for f in schema.fields if not f.nullable and f.name in nullable]


def _any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns], F.lit(False))


def violations(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Observation, list[str]]:
    """(rows that violate, with ``violated``: the first violated column, and
    ``all_violated``: all of them; the observation that counts rows by column
    while they are written; the columns checked)."""
    columns = required_columns(df, schema)
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    bad = df.where(_any_null(columns)).withColumn("all_violated", names)
    bad = bad.withColumn("violated", F.get("all_violated", F.lit(0)))
    seen = Observation(f"required-{uuid.uuid4().hex}")
    counts = [F.count_if(F.array_contains("all_violated", c)).alias(c) for c in columns]
    return bad.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen, columns


def split_required(df: DataFrame, schema: T.StructType, rejects: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    """(``df`` without the rows that violate a REQUIRED column of ``schema``,
    violating rows by column).

    Without ``rejects`` any violation refuses the whole table
    (``RequiredColumnError``).  With it the rows are written below that folder,
    partitioned by the violated column, under a name of their own.
    """
    if not required_columns(df, schema):
        return df, {}
    bad, seen, columns = violations(df, schema)
    if rejects is None:
        bad.write.format("noop").mode("overwrite").save()
    else:
        bad.write.partitionBy("violated").parquet(f"{rejects.rstrip('/')}/{uuid.uuid4().hex}")
    found = seen.get
    counts = {c: found[c] for c in columns if found.get(c)}
    if counts and rejects is None:
        raise RequiredColumnError(counts)
    return df.where(~_any_null(columns)), counts


def checked(df: DataFrame, schema: T.StructType, rejects: str | None = None) -> DataFrame:
    """The rows that ``split_required`` lets through."""
    return split_required(df, schema, rejects)[0]
