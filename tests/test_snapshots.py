"""Tables switch from one snapshot to the next in one step."""

import os

import pytest
from pyspark.sql import types as T

from parley.operators import snapshots
from parley.operators.snapshots import read_snapshot, remove_superseded, write_snapshot

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("day", T.DateType()), T.StructField("v", T.StringType())])


def table(spark, *rows):
    return spark.createDataFrame([(k, d, v) for k, d, v in rows], "k long, day string, v string").selectExpr(
        "k", "CAST(day AS DATE) AS day", "v"
    )


def rows(spark, path, by=None, **kwargs):
    return sorted((r.k, str(r.day), r.v) for r in read_snapshot(spark, path, SCHEMA, by, **kwargs).collect())


def test_no_table_is_empty(spark, tmp_path):
    df = read_snapshot(spark, str(tmp_path / "none"), SCHEMA, "day")
    assert df.columns == ["k", "day", "v"] and df.count() == 0


@pytest.mark.parametrize("by", [None, "day"])
def test_a_job_that_stops_before_the_switch_leaves_the_old_table(spark, tmp_path, monkeypatch, by):
    path = str(tmp_path / "t")
    write_snapshot(table(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b")), path, by)
    old = rows(spark, path, by)

    def stop(self, old, new):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(snapshots._Folder, "rename", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            write_snapshot(table(spark, (1, "2024-01-01", "new")), path, by)
    assert [n for n in os.listdir(path) if n.startswith("_next-")]  # written, not switched to
    assert rows(spark, path, by) == old
    # Running it again switches; the hidden folder goes with the next clean-up.
    write_snapshot(table(spark, (1, "2024-01-01", "new")), path, by)
    now = rows(spark, path, by)
    assert (1, "2024-01-01", "new") in now and (1, "2024-01-01", "a") not in now
    assert remove_superseded(spark, path, by) >= 2
    assert rows(spark, path, by) == now and not [n for n in os.listdir(path) if n.startswith("_next-")]


def test_partitions_come_from_their_newest_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_snapshot(table(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b"), (3, None, "c")), path, "day") == 1
    # The new rows are made from the table itself.
    grown = read_snapshot(spark, path, SCHEMA, "day", partitions=["2024-01-02"]).unionByName(table(spark, (4, "2024-01-02", "d")))
    assert write_snapshot(grown, path, "day") == 2
    want = [(1, "2024-01-01", "a"), (2, "2024-01-02", "b"), (3, "None", "c"), (4, "2024-01-02", "d")]
    assert rows(spark, path, "day") == want
    assert rows(spark, path, "day", partitions=["2024-01-01"]) == want[:1]
    assert rows(spark, path, "day", partitions=["1999-01-01"]) == []
    assert remove_superseded(spark, path, "day") == 1 and rows(spark, path, "day") == want


@pytest.mark.parametrize("by", [None, "day"])
def test_a_table_written_in_place_is_version_zero(spark, tmp_path, by):
    path = str(tmp_path / "t")
    writer = table(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b")).write
    (writer.partitionBy(by) if by else writer).parquet(path)
    assert len(rows(spark, path, by)) == 2
    write_snapshot(table(spark, (2, "2024-01-02", "new")), path, by)
    assert rows(spark, path, by) == ([(1, "2024-01-01", "a")] if by else []) + [(2, "2024-01-02", "new")]
    remove_superseded(spark, path, by)
    assert (2, "2024-01-02", "new") in rows(spark, path, by)


def test_of_two_writers_of_one_version_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_snapshot(table(spark, (1, "2024-01-01", "a")), path)
    monkeypatch.setattr(snapshots, "_versions", lambda folder: [])  # as if version 1 had not been seen
    with pytest.raises(Exception, match="already exists"):
        write_snapshot(table(spark, (2, "2024-01-01", "b")), path)
    monkeypatch.undo()
    assert rows(spark, path) == [(1, "2024-01-01", "a")]
