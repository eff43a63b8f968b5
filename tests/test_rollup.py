from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from anemos.operators import metrics, periods, reports, rollup
from anemos.plans import jobs


def day(n, h=0, m=0):
    return dt.datetime(2024, 5, n, h, m)


def grid(spark, start, end, period):
    df = spark.range(1).select(rollup.naive(start).alias("start"), rollup.naive(end).alias("end"))
    made = periods.day_grid(df) if period == "time" else periods.period_grid(df, period)
    return [(r.period_start, r.period_end) for r in made.orderBy("period_start").collect()]


def test_grid_cuts_start_and_passes_end(spark):
    assert grid(spark, dt.datetime(2024, 5, 1, 2, 3, 40), day(1, 2, 20), "10min") == [
        (day(1, 2, 3), day(1, 2, 13)), (day(1, 2, 13), day(1, 2, 23)),
    ]
    assert grid(spark, day(1, 2, 3), day(1, 4), "hour") == [(day(1, 2), day(1, 3)), (day(1, 3), day(1, 4))]
    assert grid(spark, day(1, 2, 3), day(2), "day") == [(day(1), day(2))]


def test_grid_of_months_and_years(spark):
    months = grid(spark, dt.datetime(2024, 1, 31), dt.datetime(2024, 3, 1, 1), "month")
    assert [start for start, _ in months] == [dt.datetime(2024, m, 1) for m in (1, 2, 3)]
    years = grid(spark, dt.datetime(2023, 11, 5), dt.datetime(2025, 1, 1), "year")
    assert years == [(dt.datetime(2023, 11, 1), dt.datetime(2024, 11, 1)),
                     (dt.datetime(2024, 11, 1), dt.datetime(2025, 11, 1))]


def test_empty_and_unknown_period(spark):
    assert grid(spark, day(2), day(1), "hour") == []
    with pytest.raises(ValueError):
        grid(spark, day(1), day(2), "week")


def test_day_slices(spark):
    assert grid(spark, day(1, 2, 3), day(3, 1), "time") == [
        (day(1, 2, 3), day(2)), (day(2), day(3)), (day(3), day(3, 1)),
    ]
    assert grid(spark, day(1), day(2), "time") == [(day(1), day(2))]


@pytest.mark.parametrize("period", ["10min", "hour", "day", "month", "year"])
def test_period_of_agrees_with_grid(spark, period):
    start, end = dt.datetime(2023, 11, 29, 7, 58), dt.datetime(2024, 3, 2, 1, 1)
    cells = grid(spark, start, end, period)
    times = spark.range(0, 90 * 24 * 6, 7).select(
        (rollup.naive(start) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int") * 10)).alias("t")
    )
    found = times.select("t", periods.period_of(F.col("t"), rollup.naive(start), period).alias("p")).collect()
    starts = dict(cells)
    assert found and all(row.p in starts and row.p <= row.t < starts[row.p] for row in found)


NAMES_BY_RULE = {
    "max": [n for n in metrics.SUMMARY_COLUMNS if n.endswith("Max")],
    "min": [n for n in metrics.SUMMARY_COLUMNS if n.endswith("Min")],
    "sum": ["GriActiveEnergyDelTotal", "YawCwTimesSum", "GenReactQLimitStateTimesSum",
            "PreTotalGenerationFirst", "PreTotalEleConsumptionFirst", "YawHoursTotal"],
    "avg": ["Count", "YawHours", "EquivalentHours", "Met1sWSpdAvg", *metrics.AVAILABILITY_COLUMNS[3:],
            *metrics.EFFICIENCY_COLUMNS[3:]],
}


@pytest.mark.parametrize("rule", NAMES_BY_RULE)
def test_rules_by_name(rule):
    assert {name: rollup.merge_rule(name) for name in NAMES_BY_RULE[rule]} == dict.fromkeys(NAMES_BY_RULE[rule], rule)


def test_column_counts():
    assert [len(c) for c in metrics.REPORT_COLUMNS.values()] == [54, 32, 13]


@pytest.fixture(scope="module")
def store(spark):
    rows = [
        (day(1, 0), "A", 10, 1.0, 5.0, "x"), (day(1, 0, 10), "A", 20, 3.0, None, "y"),
        (day(1, 0), "B", 30, 5.0, 7.0, "z"), (day(1, 1), "B", 50, 9.0, 1.0, "w"),
    ]
    return spark.createDataFrame(
        rows, "Time timestamp_ntz, DeviceName string, Count bigint, WindMax double, EnergyTotal double, Note string"
    )


def test_rollup_by_hand(spark, store):
    groups = [{"both": ["A", "B", "A"]}, {"none": []}]
    rows = rollup.rollup(store, groups, "hour", day(1), day(1, 3), formulas={"Half": "WindMax / 2"})
    got = {(r.group_ord, r.Time.hour): r for r in rows.collect()}
    assert len(got) == 6
    first = got[0, 0]
    assert (first.DeviceName, first.Count, first.WindMax, first.EnergyTotal, first.Note, first.Half) == (
        "both", 20.0, 5.0, 12.0, "x", 2.5)
    assert (got[0, 1].Count, got[0, 1].EnergyTotal) == (50.0, 1.0)
    empty = got[0, 2]
    assert (empty.DeviceName, empty.Time, empty.Count, empty.Half) == ("both", day(1, 2), None, None)
    assert all(got[1, hour].Count is None and got[1, hour].DeviceName == "none" for hour in range(3))


def test_one_device_one_period_is_its_row(spark, telemetry):
    rows = reports.summary(reports.window_totals(telemetry))
    row = rows.orderBy("Time").first()
    rolled = rollup.rollup(rows, [{"g": [row.DeviceName]}], "10min", row.Time, row.Time + dt.timedelta(minutes=10)).first()
    for name in metrics.SUMMARY_COLUMNS[2:]:
        assert rolled[name] == pytest.approx(row[name]), name


def test_additive_rules_of_one_window_give_its_row(spark, telemetry):
    rows = reports.combined(reports.window_totals(telemetry))
    row = rows.where("TheoreticalGeneration > 0 and FaultShutdownTimes > 0").orderBy("Time").first() or rows.orderBy("Time").first()
    rolled = rollup.rollup(
        rows, [{"g": [row.DeviceName]}], "10min", row.Time, row.Time + dt.timedelta(minutes=10), rules="additive").first()
    for name in metrics.COMBINED_COLUMNS[2:]:
        assert rolled[name] == pytest.approx(row[name]), name


def test_additive_rules_need_their_inputs(spark, telemetry):
    rows = reports.efficiency(reports.window_totals(telemetry))
    with pytest.raises(ValueError, match="TheoreticalGeneration"):
        rollup.rollup(rows, [{"g": ["x"]}], "day", day(1), day(2), rules="additive")
    with pytest.raises(ValueError, match="rules"):
        rollup.rollup(rows, [{"g": ["x"]}], "day", day(1), day(2), rules="odd")


def test_groups_keep_order_and_drop_doubles(spark):
    table = rollup.group_table(spark, [{"b": ["2", "2", "1"]}, {"a": ["2"]}])
    assert [tuple(r) for r in table.collect()] == [(0, "b", "2"), (0, "b", "1"), (1, "a", "2")]


def test_unknown_report_kind(telemetry):
    with pytest.raises(ValueError):
        jobs.ad_hoc_report(telemetry, "Nothing", [{"g": ["x"]}], day(1), day(2))
