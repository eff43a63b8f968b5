from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from anemos import plans as jobs
from anemos import streaming
from anemos.operators import reports
from anemos.sinks import read_table, snapshot
from anemos.sources import scan_arrivals, scan_reports


def test_stream_is_the_batch_for_closed_windows(spark, telemetry, tmp_path):
    """Samples arrive as four files over four batches."""
    source = tmp_path / "in"
    source.mkdir()
    ordered = telemetry.orderBy("time").collect()
    quarter = len(ordered) // 4
    for n in range(4):
        part = ordered[n * quarter: (n + 1) * quarter if n < 3 else None]
        spark.createDataFrame(part, telemetry.schema).coalesce(1).write.mode("append").parquet(str(source))
    arriving = streaming.read_arrivals(spark, str(source), telemetry.schema, files_per_batch=1)
    rows = streaming.stream_reports(arriving)
    streaming.write_stream(rows, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.schema(rows.schema).parquet(str(tmp_path / "out"))
    newest = telemetry.agg(F.max("time")).first()[0]
    want = reports.combined(reports.window_totals(telemetry)).where(
        F.col("Time") + F.expr("INTERVAL 20 MINUTE") <= F.lit(newest.isoformat(sep=" ")).cast("timestamp_ntz")
    )
    names = ["Time", "DeviceName", "Count", "GriActiveEnergyDelTotal", "FaultShutdownDuration", "Availability", "Met1sWSpdMax"]
    left, right = got.select(names), want.select(names)
    assert got.count() == want.count() > 0
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0
    # starting again finds nothing new and writes nothing twice
    streaming.write_stream(rows, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == want.count()


SAMPLE = "time timestamp_ntz, turbine string, v int"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SAMPLE).coalesce(1).write.mode("append").parquet(str(folder))


def test_merging_arrivals(spark, tmp_path):
    source, table, late, state = (str(tmp_path / n) for n in ("in", "table", "late", "state"))
    first, second = dt.datetime(2024, 5, 1, 12), dt.datetime(2024, 5, 2, 12)
    schema = spark.createDataFrame([], SAMPLE).schema

    def run(state_dir=state):
        stream = streaming.read_arrivals(spark, source, schema)
        streaming.merge_arrivals(stream, table, state_dir, late).awaitTermination()
        return {(r.time, r.turbine): r.v for r in read_table(spark, table).collect()}

    arrive(spark, source, [(first, "A", 1), (second, "A", 2), (second, "B", 3)])
    assert run() == {(first, "A"): 1, (second, "A"): 2, (second, "B"): 3}
    # one sample replaced, one of a new day, one of the first day, which is late
    third = dt.datetime(2024, 5, 3, 12)
    arrive(spark, source, [(second, "B", 30), (third, "A", 4), (first, "B", 5)])
    want = {(first, "A"): 1, (first, "B"): 5, (second, "A"): 2, (second, "B"): 30, (third, "A"): 4}
    assert run() == want
    assert [(r.time, r.turbine) for r in spark.read.parquet(f"{late}/samples").collect()] == [(first, "B")]
    # all files once more, as after a lost checkpoint: no duplicates
    arrive(spark, source, [(second, "B", 30)])
    assert run() == want
    assert read_table(spark, table).count() == 5


def test_a_batch_may_run_again(spark, tmp_path):
    table = str(tmp_path / "table")
    batch = spark.createDataFrame([(dt.datetime(2024, 5, 1), "A", 1), (dt.datetime(2024, 5, 1), "A", 1)], SAMPLE)
    for _ in range(3):
        streaming.merge_batch(batch, 0, table, str(tmp_path / "late"))
    assert read_table(spark, table).count() == 1


def test_a_batch_reads_only_its_hours(spark, tmp_path):
    """Hours the batch does not touch keep their files."""
    table = tmp_path / "table"
    noon, night = dt.datetime(2024, 5, 1, 12), dt.datetime(2024, 5, 1, 23)
    streaming.merge_batch(spark.createDataFrame([(noon, "A", 1), (night, "A", 2)], SAMPLE), 0, str(table), hours=True)
    before = snapshot(spark, str(table)).files
    streaming.merge_batch(spark.createDataFrame([(night, "B", 3)], SAMPLE), 1, str(table), hours=True)
    after = snapshot(spark, str(table)).files
    assert after["dt=2024-05-01/hr=12"] == before["dt=2024-05-01/hr=12"]
    assert after["dt=2024-05-01/hr=23"] != before["dt=2024-05-01/hr=23"]
    assert sorted(r.v for r in read_table(spark, str(table)).collect()) == [1, 2, 3]


def test_batches_leave_nothing_behind(spark, tmp_path):
    from anemos import session

    made, plain = [], session.scratch_path
    session.scratch_path = lambda *args: made.append(plain(*args)) or made[-1]
    try:
        noon = dt.datetime(2024, 5, 1, 12)
        for batch_id in range(4):
            batch = spark.createDataFrame([(noon + dt.timedelta(days=batch_id), "A", 1), (noon, "B", batch_id), (noon, "B", 7)], SAMPLE)
            streaming.merge_batch(batch, batch_id, str(tmp_path / "t"), str(tmp_path / "late"))
    finally:
        session.scratch_path = plain
    import os

    assert made and not any(os.path.exists(path.removeprefix("file:")) for path in made)
    assert len(list((tmp_path / "late" / "bounds").glob("batch=*"))) == 2
    assert {r.v for r in read_table(spark, str(tmp_path / "t")).where("turbine = 'B'").collect()} == {7}
    assert spark.read.parquet(str(tmp_path / "late" / "samples")).count() == 2


def test_reports_of_arriving_files(spark, telemetry, tmp_path):
    """Two batches of files; the second brings one device and time again."""
    source, store = tmp_path / "in", str(tmp_path / "store")
    samples = telemetry.where("turbine = 'WF01_001'").orderBy("time").limit(12).toArrow()

    def arrive_as(name, rows):
        source.mkdir(exist_ok=True)
        pq.write_table(rows, source / name)

    def run():
        stream = streaming.read_arrivals(spark, str(source), telemetry.schema, file_keys=True)
        streaming.store_arrivals(stream, store, str(tmp_path / "state")).awaitTermination()
        rows = scan_reports(spark, store, "SummaryReport").collect()
        assert scan_reports(spark, store, "EfficiencyMetrics").count() == len(rows)
        return {(r.DeviceName, r.Time.isoformat()): r.Count for r in rows}

    arrive_as("WF01_001_202405010003_a.parquet", samples.slice(0, 5))
    arrive_as("WF01_002_202405010017_a.parquet", samples.slice(5, 3))
    want = {("WF01_001", "2024-05-01T00:00:00"): 5, ("WF01_002", "2024-05-01T00:10:00"): 3}
    assert run() == want
    # a second file of the first report's ten minutes adds to it
    arrive_as("WF01_001_202405010008_b.parquet", samples.slice(5, 4))
    arrive_as("WF01_001_202405020000_a.parquet", samples.slice(0, 2))
    want |= {("WF01_001", "2024-05-01T00:00:00"): 9, ("WF01_001", "2024-05-02T00:00:00"): 2}
    assert run() == want
    # a batch once more, as after a failure between the tables
    jobs.merge_file_reports(scan_arrivals(spark, str(source / "WF01_001_202405020000_a.parquet")), store)
    assert run() == want


def test_stream_session_leaves_the_other_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = streaming.stream_session(spark, 3)
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert session.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_replayed_file_touches_nothing(spark, tmp_path):
    source, table, state, late = (str(tmp_path / n) for n in ("in", "table", "state", "late"))
    noon, schema = dt.datetime(2024, 5, 1, 12), spark.createDataFrame([], SAMPLE).schema
    rows = [(noon, "A", 1), (noon + dt.timedelta(days=1), "B", 2)]

    def run():
        stream = streaming.read_arrivals(spark, source, schema)
        streaming.merge_arrivals(stream, table, state, late, replay="2 days").awaitTermination()
        return snapshot(spark, table).version, sorted(r.v for r in read_table(spark, table).collect())

    arrive(spark, source, rows)
    assert run() == (0, [1, 2])
    arrive(spark, source, rows)
    assert run() == (0, [1, 2])
    # a late sample and a corrected one are no replays
    arrive(spark, source, [(noon - dt.timedelta(days=9), "A", 7), (noon, "A", 5)])
    assert run() == (1, [2, 5, 7])
