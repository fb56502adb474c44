"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import ensure_checkpoint_dir

# Functions that run in Python workers travel by value, so executors need no
# copy of this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules["parley.llm"])

# The six ASCII white-space characters; a word is a maximal run of others.
ASCII_SPACE = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back:
    cuts the lineage, survives lost executors and keeps column pruning."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_in_buckets(df: DataFrame, name: str, key: str, buckets: int) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` written as a table with ``buckets`` buckets of ``key`` in the
    shared checkpoint folder, so that joins on the key exchange its rows no
    more, and what drops the table from the catalog (its files stay)."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table), lambda: spark.sql(f"DROP TABLE {table}")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4_000_000):
    """Arrow batches of at most ``rows`` rows and about ``size`` bytes (one row
    at least) for jobs that run inside: whole texts are long, and the defaults
    of 10,000 rows and 64 MB fill the memory of the executor and of its Python
    worker."""
    limits = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": rows,
        "spark.sql.execution.arrow.maxBytesPerBatch": size,
    }
    before = {key: spark.conf.get(key, None) for key in limits}
    for key, limit in limits.items():
        # A limit that is not plain digits, such as "64m", is replaced.
        now = before[key] or ""
        spark.conf.set(key, str(min(limit, int(now)) if now.isdigit() and int(now) > 0 else limit))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text, in order; an empty array for NULL and blank texts."""
    stripped = F.btrim(F.coalesce(text, F.lit("")), F.lit(ASCII_SPACE))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, SPACE_RUN, -1))


def word_count(text: Column) -> Column:
    """The number of words of a text as BIGINT; 0 for NULL."""
    stripped = F.btrim(F.coalesce(text, F.lit("")), F.lit(ASCII_SPACE))
    return F.when(stripped == "", 0).otherwise(F.size(F.split(stripped, SPACE_RUN, -1))).cast("bigint")


def bucket_offsets(counts: DataFrame, group: str, bucket: str, count: str) -> DataFrame:
    """For counts per (group, bucket), the number of rows in earlier buckets of
    the group, as ``rows_before``.  A window over counts, never over rows."""
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("rows_before", F.coalesce(F.sum(count).over(w), F.lit(0).cast("bigint")))


def bounded_rows(keys: DataFrame, rows: DataFrame, id_col: str, limit: int, salt: str) -> DataFrame:
    """The rows whose id is among the ``limit`` ids of ``keys`` with the least
    seeded hash: a sample that depends on the ids alone.  Only ids are put in
    order, and the broadcast list has at most ``limit`` of them."""
    ids = (
        keys.select(F.col(id_col).alias("__id"))
        .where("__id IS NOT NULL")
        .distinct()
        .orderBy(F.xxhash64("__id", F.lit(salt)), "__id")
        .limit(limit)
    )
    return rows.join(F.broadcast(ids), F.col(id_col) == F.col("__id"), "left_semi")


def hand_back_memory() -> None:
    """Return freed memory of this Python worker to the machine: workers stay
    for later tasks, which need their share of the executor's memory."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def worker_kept() -> dict:
    """What tasks of this Python worker process keep for later ones."""
    return sys.modules.setdefault("_parley_worker", types.ModuleType("_parley_worker")).__dict__.setdefault("kept", {})


def drop_kept() -> None:
    """At the start of a task that uses nothing kept: free what tasks of an
    earlier operator left in this worker."""
    kept = worker_kept()
    if kept:
        kept.clear()
        hand_back_memory()
