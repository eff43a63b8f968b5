"""Blocks of totals, covers of ranges, and reports kept up with late samples."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from anemos import plans, streaming
from anemos.operators import blocks, metrics, reports, rollup
from anemos.plans import upkeep
from anemos.sinks import read_table, snapshot
from anemos.sources import scan_reports

START = dt.datetime(2024, 5, 1)


def test_cover_of_ranges():
    assert blocks.cover(dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 1)) == [("month", dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 1))]
    assert blocks.cover(START, START) == []
    with pytest.raises(ValueError):
        blocks.cover(START, START + dt.timedelta(minutes=5))
    rng = random.Random(1)
    length = {"10min": 600, "hour": 3600, "day": 86400}
    for _ in range(300):
        low = dt.datetime(2023, 1, 1) + dt.timedelta(minutes=10 * rng.randrange(70_000))
        high = low + dt.timedelta(minutes=10 * rng.choice([rng.randrange(200), rng.randrange(5000), rng.randrange(120_000)]))
        runs = blocks.cover(low, high)
        # gapless, in order, each run on its own blocks
        assert [run[1] for run in runs] + [high] == [low] + [run[2] for run in runs] or low == high and not runs
        count = {level: 0 for level in blocks.LEVELS}
        for level, a, b in runs:
            assert blocks._block_start(a, level) == a and blocks._block_start(b, level) == b and a < b
            count[level] += 0 if level == "month" else (b - a).total_seconds() / length[level]
        assert count["10min"] <= 10 and count["hour"] <= 46 and count["day"] <= 60


def close(one, other):
    if one is None or other is None or not isinstance(one, float):
        return one == other
    return math.isclose(one, other, rel_tol=1e-9, abs_tol=1e-9)


def same_rows(left, right, columns):
    key = lambda row: (row["DeviceName"], row["Time"])
    a, b = (sorted(df.select("DeviceName", "Time", *columns).collect(), key=key) for df in (left, right))
    assert [key(row) for row in a] == [key(row) for row in b]
    for one, other in zip(a, b):
        assert all(close(one[name], other[name]) for name in columns), (one, other)


@pytest.mark.parametrize("every, level", [("10 MINUTE", "10min"), ("1 HOUR", "hour"), ("1 DAY", "day"), ("1 MONTH", "month")])
def test_blocks_are_the_samples(telemetry, every, level):
    """Merged from level to level, blocks give the metrics of the samples, but for what is missing of each ten minutes."""
    made = blocks.sample_blocks(telemetry)
    for step in list(blocks.LEVELS)[1:list(blocks.LEVELS).index(level) + 1]:
        made = blocks.longer_blocks(made, step)
    columns = [name for name in metrics.COMBINED_COLUMNS[2:] if name != "InterruptionDurationCalculated"]
    same_rows(blocks.block_reports(made), reports.combined(reports.window_totals(telemetry, every)), columns)


def test_ten_minutes_miss_what_they_always_missed(telemetry):
    same_rows(blocks.block_reports(blocks.sample_blocks(telemetry)), reports.combined(reports.window_totals(telemetry)),
              ["InterruptionDurationCalculated"])


def sample(spark, telemetry, rows):
    """Samples with a turbine, a time and a wind; the other signals as in one row of the fixture."""
    one = telemetry.where("MC004 IS NOT NULL").limit(1).drop("turbine", "time", "MC004", "MC082")
    made = spark.createDataFrame(rows, "turbine string, time timestamp_ntz, MC004 double")
    return made.withColumn("MC082", F.col("MC004")).crossJoin(one).select(*telemetry.columns)


def test_means_weigh_by_their_samples(spark, telemetry):
    """600 samples of mean 10 and one of mean 1."""
    rows = [("A", START + dt.timedelta(seconds=n), 10.0) for n in range(600)] + [("A", START + dt.timedelta(minutes=15), 1.0)]
    samples = sample(spark, telemetry, rows)
    groups, day = [{"g": ["A"]}], (START, START + dt.timedelta(days=1))
    stored = reports.combined(reports.window_totals(samples))
    added = rollup.rollup(stored, groups, "day", *day, ["Count", "Met1sWSpdAvg"], rules="additive").first()
    assert added["Met1sWSpdAvg"] == pytest.approx(6001 / 601) and added["Count"] == 601
    levels = {"day": blocks.longer_blocks(blocks.longer_blocks(blocks.sample_blocks(samples), "hour"), "day")}
    exact = blocks.exact_rollup(levels, groups, "day", *day, ["Count", "Met1sWSpdAvg", "InterruptionDurationCalculated"]).first()
    assert exact["Met1sWSpdAvg"] == pytest.approx(6001 / 601) and exact["InterruptionDurationCalculated"] == 599


def test_a_year_reads_twelve_blocks_a_turbine(spark, telemetry, tmp_path):
    plans.store_blocks(telemetry, str(tmp_path))
    found = plans.scan_blocks(spark, str(tmp_path), dt.datetime(2024, 1, 1), dt.datetime(2024, 12, 31))
    turbines = telemetry.select("turbine").distinct().count()
    picked = blocks.covering_blocks(found, dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1))
    assert picked.count() <= 12 * turbines
    assert {path.split("/Blocks/")[1].split("/")[0] for path in picked.inputFiles()} == {"month"}


def test_only_the_folders_of_a_range_are_opened(spark, telemetry, tmp_path):
    plans.store_blocks(telemetry, str(tmp_path))
    found = plans.scan_blocks(spark, str(tmp_path), dt.datetime(2024, 1, 9, 5), dt.datetime(2024, 1, 10, 6))
    for level, days in (("10min", 2), ("hour", 2), ("day", 1), ("month", 1)):
        assert len({path.rsplit("/", 2)[1] for path in found[level].inputFiles()}) == days


def batches(telemetry, seed):
    """Three batches without order: any sample may come in any of them."""
    share = F.pmod(F.xxhash64("time", "turbine", F.lit(seed)), F.lit(3))
    return [telemetry.where(share == n) for n in range(3)]


def test_late_samples_end_in_the_report_of_one_run(spark, telemetry, tmp_path):
    telemetry = telemetry.where("turbine < 'WF01_004'")
    table, store = str(tmp_path / "table"), str(tmp_path / "store")
    for n, batch in enumerate(batches(telemetry, 1)):
        streaming.merge_batch(batch, n, table, store=store)
    streaming.merge_batch(batches(telemetry, 1)[1], 1, table, store=store)  # once more
    want = reports.combined(reports.window_totals(telemetry))
    for kind, columns in metrics.REPORT_COLUMNS.items():
        got = scan_reports(spark, store, kind)
        assert got.count() == want.count()
        names = [name for name in columns[2:] if not name.startswith(("Theoretical", "GriActiveEnergyDelUnit"))]
        same_rows(got.select("Time", "DeviceName", *[F.round(name, 4).alias(name) for name in names]),
                  want.select("Time", "DeviceName", *[F.round(F.round(name, 6), 4).alias(name) for name in names]), ["Count"])
    whole = blocks.longer_blocks(blocks.sample_blocks(telemetry), "month")
    same_rows(blocks.block_reports(plans.scan_blocks(spark, store)["month"]), blocks.block_reports(whole), metrics.COMBINED_COLUMNS[2:])


def test_a_batch_redoes_only_its_windows(spark, telemetry, tmp_path):
    table, store = str(tmp_path / "table"), str(tmp_path / "store")
    rows = [(name, START + dt.timedelta(days=day, minutes=m), 5.0) for name in "AB" for day in (0, 1, 40) for m in (0, 20)]
    streaming.merge_batch(sample(spark, telemetry, rows), 0, table, store=store)
    before = snapshot(spark, f"{store}/Blocks/10min").files
    streaming.merge_batch(sample(spark, telemetry, [("A", START + dt.timedelta(days=1, seconds=5), 8.0)]), 1, table, store=store)
    after = snapshot(spark, f"{store}/Blocks/10min").files
    assert {name for name in after if after[name] != before[name]} == {"dt=2024-05-02"}
    found = {(r["DeviceName"], r["Time"]): (r["Count"], r["Met1sWSpdMax"]) for r in scan_reports(spark, store, "SummaryReport").collect()}
    assert found["A", START + dt.timedelta(days=1)] == (2, 8.0) and found["B", START + dt.timedelta(days=1)] == (1, 5.0)
    month = plans.scan_blocks(spark, store)["month"].where("DeviceName = 'A'").orderBy("Time").collect()
    assert [(r["Time"].month, r["Count"], r["_windows"]) for r in month] == [(5, 5, 4), (6, 2, 2)]


def test_listed_late_samples_are_redone(spark, telemetry, tmp_path):
    table, late, store = (str(tmp_path / name) for name in ("table", "late", "store"))
    first = sample(spark, telemetry, [("A", START, 5.0), ("A", START + dt.timedelta(hours=2), 5.0)])
    streaming.merge_batch(first, 0, table, late, store=store)
    assert plans.redo_late(spark, late, table, store) == -1
    streaming.merge_batch(sample(spark, telemetry, [("A", START + dt.timedelta(seconds=9), 7.0)]), 1, table, late)
    counts = lambda: [r["Count"] for r in scan_reports(spark, store, "SummaryReport").orderBy("Time").collect()]
    assert counts() == [1, 1]
    assert plans.redo_late(spark, late, table, store) == 1
    assert counts() == [2, 1]
    assert plans.redo_late(spark, late, table, store, after_batch=1) == 1


def test_files_of_one_report_add_up_over_batches(spark, telemetry, tmp_path):
    """Six samples of one turbine and ten minutes, in one batch or in two."""
    rows = sample(spark, telemetry, [("A", START + dt.timedelta(seconds=n), float(n)) for n in range(6)])

    def arrived(part, name):
        return part.withColumns({"file_path": F.lit(name), "file_device": F.lit("A"), "file_time": F.lit(START).cast("timestamp_ntz")})

    two = [arrived(rows.where("MC004 < 3"), "A_1_202405010000_a.parquet"), arrived(rows.where("MC004 >= 3"), "A_1_202405010003_b.parquet")]
    for store, parts in ((str(tmp_path / "one"), [two[0].unionByName(two[1])]), (str(tmp_path / "two"), [*two, two[1]])):
        for part in parts:
            upkeep.merge_file_reports(part, store)
        (row,) = scan_reports(spark, store, "SummaryReport").collect()
        assert (row["Count"], row["Met1sWSpdAvg"], row["Met1sWSpdMax"]) == (6, 2.5, 5.0)
    assert read_table(spark, str(tmp_path / "two" / "FileBlocks")).count() == 2
