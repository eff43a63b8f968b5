"""Tables with a log: whole commits, failures, two writers, versions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from anemos import sinks
from anemos.operators.schemas import SchemaConflict
from anemos.plans import jobs
from anemos.sinks import snapshots, tables

NOON = dt.datetime(2024, 5, 1, 12)


def rows(spark, *triples):
    return spark.createDataFrame(list(triples), "time timestamp_ntz, turbine string, val int")


def values(spark, path, **options):
    return sorted(row["val"] for row in sinks.read_table(spark, path, **options).collect())


def test_readers_follow_the_newest_entry(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.read_table(spark, path) is None
    tables.commit_slices(rows(spark, (NOON, "A", 1), (NOON + dt.timedelta(1), "A", 2)), path, "time")
    held = sinks.read_table(spark, path)
    tables.commit_slices(rows(spark, (NOON, "B", 3)), path, "time")
    assert values(spark, path) == [2, 3]
    assert values(spark, path, version=0) == [1, 2]
    # a reader that began before sees what it began with
    assert sorted(row["val"] for row in held.collect()) == [1, 2]
    with pytest.raises(ValueError):
        sinks.read_table(spark, path, version=7)


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_sorted(rows(spark, (NOON, "A", 1), (NOON, "B", 2)), path)
    broken = spark.range(0, 1000, 1, 4).select(
        F.lit(NOON).cast("timestamp_ntz").alias("time"), F.lit("A").alias("turbine"),
        F.when(F.col("id") == 700, F.raise_error(F.lit("lost")).cast("int")).otherwise(5).alias("val"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_sorted(broken, path, partitions=4)
    assert values(spark, path) == [1, 2]
    # files were left behind; no entry names them, and a later commit is not disturbed
    sinks.write_sorted(rows(spark, (NOON, "C", 9)), path)
    assert values(spark, path) == [9]


def test_a_driver_lost_before_its_entry(spark, tmp_path, monkeypatch):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    sinks.write_sorted(rows(spark, (NOON, "A", 1)), first)
    sinks.write_sorted(rows(spark, (NOON, "B", 2)), second)

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "_put", lost)
        with pytest.raises(KeyboardInterrupt):
            jobs.merge_files(spark, first, second, first)
    assert values(spark, first) == [1]
    jobs.merge_files(spark, first, second, first)
    assert values(spark, first) == [1, 2]


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    next_day = NOON + dt.timedelta(1)
    tables.commit_slices(rows(spark, (NOON, "A", 1), (next_day, "A", 2)), path, "time")
    base = snapshots.snapshot(spark, path)
    # another day: both commits count
    tables.commit_slices(rows(spark, (next_day, "A", 3)), path, "time", base=base)
    tables.commit_slices(rows(spark, (NOON, "A", 4)), path, "time", base=base)
    assert values(spark, path) == [3, 4]
    # the same day: the second must not undo the first
    with pytest.raises(sinks.CommitConflict, match="dt=2024-05-01"):
        tables.commit_slices(rows(spark, (NOON, "A", 5)), path, "time", base=base)
    assert values(spark, path) == [3, 4]


def test_two_writers_take_one_number(spark, tmp_path, monkeypatch):
    path, plain = str(tmp_path / "t"), snapshots._put
    raced = []

    def put(spark, where, name, content):
        if not raced:
            raced.append(name)
            snapshots.commit(rows(spark, (NOON, "B", 2)), path, "time", replace="nothing")
        return plain(spark, where, name, content)

    monkeypatch.setattr(snapshots, "_put", put)
    snapshots.commit(rows(spark, (NOON, "A", 1)), path, "time", replace="nothing")
    assert values(spark, path) == [1, 2] and snapshots.snapshot(spark, path).version == 1


def test_a_batch_is_committed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in (0, 1, 1, 0, 2):
        snapshots.commit(rows(spark, (NOON, "A", batch)), path, "time", replace="nothing", mark=("stream", batch))
    assert values(spark, path) == [0, 1, 2]


def test_bounds_schema_and_checkpoints(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "CHECKPOINT", 3)
    path = str(tmp_path / "t")
    for day in range(8):
        made = rows(spark, (NOON + dt.timedelta(day), "A", day))
        tables.commit_slices(made.withColumn("more", F.lit("x")) if day == 5 else made, path, "time")
    state = snapshots.snapshot(spark, path)
    assert state.version == 7 and len(state.files) == 8 and state.schema.fieldNames() == ["time", "turbine", "val", "more"]
    file = state.files["dt=2024-05-03"][0]
    assert (file.rows, file.low, file.high) == (1, "2024-05-03 12:00:00.000000", "2024-05-03 12:00:00.000000")
    assert values(spark, path, start=NOON + dt.timedelta(2), end=NOON + dt.timedelta(4)) == [2, 3, 4]
    assert len(sinks.read_table(spark, path, start=NOON + dt.timedelta(2), end=NOON + dt.timedelta(4)).inputFiles()) == 3
    assert [row["more"] for row in sinks.read_table(spark, path).orderBy("val").collect()] == [None] * 5 + ["x", None, None]
    # the newest state is read from a checkpoint and what follows it
    for version in range(6):
        (tmp_path / "t" / "_log" / f"{version:020d}.json").unlink()
    assert snapshots.snapshot(spark, path) == state
    with pytest.raises(SchemaConflict):
        tables.commit_slices(spark.createDataFrame([(NOON, "A", "one")], "time timestamp_ntz, turbine string, val string"), path, "time")


def test_empty_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.commit_slices(spark.createDataFrame([], "time timestamp_ntz, turbine string, val int"), path, "time")
    assert sinks.read_table(spark, path).collect() == []
    assert sinks.read_table(spark, path).columns == ["time", "turbine", "val", "dt"]
    tables.merge_slices(rows(spark, (NOON, "A", 1)), path, ["turbine", "time"], "time")
    assert values(spark, path) == [1]


def test_old_files_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in range(4):
        tables.commit_slices(rows(spark, (NOON, "A", v), *([(NOON + dt.timedelta(1), "A", 9)] if v == 0 else [])), path, "time")
    assert len(sinks.remove_old_files(spark, path, keep=2)) == 1
    assert values(spark, path) == [3, 9] and values(spark, path, version=2) == [2, 9]
    assert len(list((tmp_path / "t" / "_data").glob("commit=*/dt=2024-05-01"))) == 2


def test_no_footers_are_read_for_the_schema(spark, tmp_path):
    """A reader takes schema and files from the log: no job runs before the first action."""
    path = str(tmp_path / "t")
    tables.commit_slices(rows(spark, (NOON, "A", 1)), path, "time")
    spark.sparkContext.setJobGroup("reading", "reading")
    try:
        sinks.read_table(spark, path)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("reading")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
