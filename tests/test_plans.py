"""What the physical plans must and must not hold."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import re

import pytest
from pyspark.sql import functions as F

from anemos import sources
from anemos.catalog import fixtures
from anemos.operators import availability, conditions, duplicates, energy, reports, rollup
from anemos.operators.resample import resample
from anemos.plans import jobs
from anemos.sources import standard_curves


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def samples(spark, stored_telemetry):
    return spark.read.parquet(stored_telemetry)


def schema_read(text: str) -> set[str]:
    return {name for found in re.findall(r"ReadSchema: struct<(.*)>", text) for name in re.findall(r"(\w+):", found)}


def aggregates(samples):
    sums = conditions.condition_sums(samples)
    totals = reports.window_totals(samples)
    return {
        "combined": reports.combined(totals),
        "sums": sums,
        "minutes": availability.daily_minutes(sums),
        "five": energy.five_minute_rows(sums),
        "ten": energy.ten_minute_rows(sums),
        "resample": resample(samples, "1 HOUR", {"MC004": ["avg", "last"]}),
        "rollup": rollup.rollup(reports.summary(totals), fixtures.GROUPS, "day", dt.datetime(2024, 1, 1),
                                dt.datetime(2024, 1, 31), ["Met1sWSpdAvg"]),
        "ad hoc": jobs.ad_hoc_report(samples, "EfficiencyMetrics", fixtures.GROUPS, dt.datetime(2024, 1, 1),
                                     dt.datetime(2024, 1, 31)),
    }


@pytest.mark.parametrize("name", [
    "combined", "sums", "minutes", "five", "ten", "resample", "rollup", "ad hoc"])
def test_aggregates(samples, name):
    text = plan(aggregates(samples)[name])
    assert "SinglePartition" not in text
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # samples are aggregated before they are first exchanged
    if name not in ("rollup", "ad hoc"):
        assert text.index("partial_") < text.index("Arguments: hashpartitioning")


def test_combined_report_is_one_scan_and_one_exchange(samples):
    text = plan(reports.combined(reports.window_totals(samples)))
    assert text.count("Scan parquet") == 2  # tree and details
    assert text.count("hashpartitioning") == 1


def test_combined_report_is_compiled(spark, samples):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(reports.combined(reports.window_totals(samples)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"HashAggregate \[codegen id : \d+\]", text)) == 2


def test_only_needed_signals_are_read(samples):
    assert schema_read(plan(reports.efficiency(reports.window_totals(samples)))) == {
        "time", "turbine", "MC082", "MC006", "preTotalGeneration", "TheoreticalGeneration", *(
            f"{x}LossGeneration" for x in ("Fault", "Overhaul", "Maintain", "Grid", "Remote", "Local", "Weather", "Limit"))}
    assert schema_read(plan(conditions.condition_sums(samples))) == {"time", "turbine", "MC531", "MC004", "MC209", "MC132"}
    assert schema_read(plan(resample(samples, "1 HOUR", {"MC004": ["avg"]}))) == {"time", "turbine", "MC004"}


def test_filters_reach_the_scan(spark, stored_telemetry):
    df = sources.scan_telemetry(spark, stored_telemetry, start=dt.datetime(2024, 1, 5, 3), end=dt.datetime(2024, 1, 6),
                                devices=["WF01_001", "WF01_002"])
    text = plan(resample(df, "1 HOUR", {"MC004": ["avg"]}))
    assert re.search(r"PartitionFilters: .*dt#\d+ >= 2024-01-05.*dt#\d+ <= 2024-01-06", text)
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(time.*In\(turbine", text)


def test_device_day_prunes_to_a_day(spark, samples):
    text = plan(sources.scan_device_day(samples, "WF01_001", dt.date(2024, 1, 9)))
    assert re.search(r"PartitionFilters: .*dt#\d+ = 2024-01-09", text)
    assert re.search(r"PushedFilters: .*EqualTo\(turbine,WF01_001\)", text)


def test_stored_report_prunes_days(spark, samples, tmp_path):
    jobs.store_reports(jobs.ten_minute_reports(samples), str(tmp_path))
    rows = sources.scan_reports(spark, str(tmp_path), "SummaryReport")
    text = plan(jobs.stored_report(rows, [{"g": ["WF01_001"]}], "hour", dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 10),
                                   ["YawHours"]))
    assert re.search(r"PartitionFilters: .*dt#\d+ >=", text)
    assert schema_read(text) == {"Time", "DeviceName", "YawHours"}


def test_potential_energy_shuffles_by_turbine_and_window(spark, samples):
    rows = jobs.pba_rows(conditions.condition_sums(samples), fixtures.turbine_info(spark), standard_curves(spark))
    text = plan(energy.with_potential(rows))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "Python" not in text
    for keys in re.findall(r"Arguments: hashpartitioning\((.*?), \d+\)", text):
        assert "w#" in keys or "turbine_type#" in keys


def test_hot_key_duplicates(spark):
    """A third of the rows share one key; none is lost and no window gathers them."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    made = duplicates.duplicate_keys(df, ["k"])
    assert "Window" not in plan(made)
    row = made.agg(F.count(F.lit(1)), F.countDistinct("v"), F.min("copies")).first()
    assert tuple(row) == (10_000, 10_000, 10_000)


def test_tasks_need_no_installed_package(tmp_path):
    """Python functions of tasks travel by value: a process that cannot import
    this package can load and call them."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    from anemos.operators import curves
    from anemos.sources import inventory

    (tmp_path / "f").write_bytes(cloudpickle.dumps((curves.bootstrap_samples, inventory._footer_rows)))
    code = (
        "import importlib.util, pickle\n"
        "assert importlib.util.find_spec('anemos') is None\n"
        "draw, _ = pickle.load(open('f', 'rb'))\n"
        "print(draw(45, 50, 45).shape)\n"
    )
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not os.path.isdir(os.path.join(p, "anemos"))]
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(paths)}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "(50, 45)", done.stderr
