"""Tables that switch from one snapshot to the next with one rename.

A table is a folder of committed versions, ``snapshot_version=1``, ``snapshot_version=2``, ...  A write goes
to a hidden folder beside them (Spark skips names that start with ``_``) and
becomes a version by renaming that folder: a job that stops before the rename
leaves the table as it was, and a retry starts a hidden folder of its own.  The
rename refuses an existing name, so of two writers of one version one fails.

* A table without partitions is its newest version.
* A partitioned table takes every partition from the newest version that has
  it, so a write holds only the partitions it replaces, and all of them switch
  together.

Files that lie in the folder itself (a table written in place) count as version
0.  ``remove_superseded`` deletes what no reader of the current snapshot needs;
call it when the readers of older snapshots are done.  Listing is driver work
bounded by versions x partitions; there is no log and no file list to keep.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = re.compile(r"snapshot_version=(\d+)$")


class _Folder:
    """A folder in whatever file system Spark finds behind its path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()

    def at(self, *names: str):
        return self.hadoop.Path("/".join([self.path, *names]))

    def names(self, *below: str) -> list[str]:
        """Names of the entries; none where the folder does not exist."""
        at = self.at(*below)
        fs = at.getFileSystem(self.conf)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def rename(self, old: str, new: str) -> None:
        """One rename, atomic where the file system's is; refused when ``new``
        exists."""
        uri = self.at(old).getFileSystem(self.conf).getUri()
        how = getattr(self.hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(how, 1)
        options[0] = how.NONE
        self.hadoop.FileContext.getFileContext(uri, self.conf).rename(self.at(old), self.at(new), options)

    def delete(self, *below: str) -> None:
        at = self.at(*below)
        at.getFileSystem(self.conf).delete(at, True)


def _versions(folder: _Folder) -> list[int]:
    """Committed versions, oldest first."""
    return sorted(int(m.group(1)) for m in map(VERSION.match, folder.names()) if m)


def _visible(names: list[str]) -> list[str]:
    return [n for n in names if not n.startswith(("_", "."))]


def _partition_folders(folder: _Folder, column: str) -> dict[str, list[str]]:
    """Partition folder name -> the versions' folders that have it, oldest
    first; a partition of version 0 lies in the table's own folder."""
    found: dict[str, list[str]] = {}
    own = [n for n in _visible(folder.names()) if n.startswith(f"{column}=")]
    for name in own:
        found.setdefault(name, []).append(name)
    for version in _versions(folder):
        for name in _visible(folder.names(f"snapshot_version={version}")):
            found.setdefault(name, []).append(f"snapshot_version={version}/{name}")
    return found


def read_snapshot(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: str | None = None,
    partitions: list | None = None,
) -> DataFrame:
    """The current snapshot of the table at ``path``, with the columns of
    ``schema``; empty where there is none, an error where it cannot be read.

    ``partitions`` names the partition values to read; the folders of others
    are not opened.
    """
    folder = _Folder(spark, path)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    if partition_by is None:
        versions = _versions(folder)
        if versions:
            return spark.read.parquet(f"{folder.path}/snapshot_version={versions[-1]}").select(columns)
        if not _visible(folder.names()):
            return spark.createDataFrame([], schema)
        return spark.read.parquet(folder.path).select(columns)
    current = {name: places[-1] for name, places in _partition_folders(folder, partition_by).items()}
    if partitions is not None:
        wanted = {f"{partition_by}={value}" for value in partitions}
        current = {name: place for name, place in current.items() if name in wanted}
    if not current:
        return spark.createDataFrame([], schema)
    stored = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    reader = spark.read.schema(stored).option("basePath", folder.path)
    # Partitions of version 0 lie one level higher than the others.
    own = [f"{folder.path}/{place}" for place in current.values() if "/" not in place]
    committed = [f"{folder.path}/{place}" for place in current.values() if "/" in place]
    parts = [reader.parquet(*places).select(columns) for places in (own, committed) if places]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def write_snapshot(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Write ``df`` beside the table and switch to it; returns the version.

    With ``partition_by`` the partitions in ``df`` replace those of the table
    and all others stay; without it ``df`` is the new table.  ``df`` may read
    the table itself, as nothing of the current snapshot is touched.  Rows of
    one partition are brought together first, so each writes few files.
    """
    folder = _Folder(df.sparkSession, path)
    version = max(_versions(folder), default=0) + 1
    hidden = f"_next-{uuid.uuid4().hex}"
    if partition_by:
        # Rebalancing splits a large partition and joins small ones.
        df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(f"{folder.path}/{hidden}")
    else:
        df.write.parquet(f"{folder.path}/{hidden}")
    folder.rename(hidden, f"snapshot_version={version}")
    return version


def remove_superseded(spark: SparkSession, path: str, partition_by: str | None = None) -> int:
    """Delete folders that the current snapshot does not read (older versions
    or partitions, and hidden folders of writes that never ended); returns how
    many.  Not to be run beside a writer."""
    folder = _Folder(spark, path)
    versions = _versions(folder)
    stale = [n for n in folder.names() if n.startswith("_next-")]
    if partition_by is None:
        stale += [f"snapshot_version={v}" for v in versions[:-1]]
        if versions:
            stale += [n for n in _visible(folder.names()) if not VERSION.match(n)]
    else:
        for places in _partition_folders(folder, partition_by).values():
            stale += places[:-1]
    for name in stale:
        folder.delete(*name.split("/"))
    return len(stale)
