from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from anemos.operators import metrics, reports


@pytest.fixture(scope="module")
def totals(telemetry):
    return reports.window_totals(telemetry)


def test_schemas(totals):
    for kind, make in (("SummaryReport", reports.summary), ("TurbineAvailabilityMetrics", reports.availability),
                       ("EfficiencyMetrics", reports.efficiency)):
        made = make(totals)
        assert tuple(made.columns) == metrics.REPORT_COLUMNS[kind]
        types = dict(made.dtypes)
        assert (types.pop("Time"), types.pop("DeviceName"), types.pop("Count")) == ("timestamp_ntz", "string", "bigint")
        assert set(types.values()) == {"double"}


def test_combined_is_the_three_reports(totals):
    both = reports.combined(totals)
    for make in (reports.summary, reports.availability, reports.efficiency):
        alone = make(totals)
        left, right = both.select(alone.columns), alone
        assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_states_and_the_rest_add_up(telemetry):
    every = reports.window_totals(telemetry, "1 DAY")
    rows = reports.availability(every).join(
        every.select("Time", "DeviceName", F.col("_rows").alias("n")), ["Time", "DeviceName"]
    )
    unlisted = telemetry.where(~F.col("MC143").isin([s.code for s in metrics.STATES])).count()
    sums = rows.select((F.col("n") - F.col("AvailableTime") - F.col("UnAvailableTime")).alias("rest")).agg(F.sum("rest"))
    assert sums.first()[0] == unlisted > 0


def _samples(spark, telemetry, *changes):
    """One sample per dictionary, each a changed copy of the first sample."""
    base = telemetry.orderBy("time").first().asDict()
    return spark.createDataFrame([{**base, **change} for change in changes], telemetry.schema)


def test_by_hand(spark, telemetry):
    t = dt.datetime(2024, 1, 1)
    common = {"turbine": "X", "RatedPower": 0.0, "MC082": None}
    rows = _samples(
        spark, telemetry,
        {**common, "time": t, "MC143": 40, "FaultShutdownTimes": 0, "MC006": 10.0, "preTotalGeneration": 7.0,
         "MD001": 5.0, "TheoreticalGeneration": 0.0},
        {**common, "time": t + dt.timedelta(seconds=1), "MC143": 120, "FaultShutdownTimes": 0, "MC006": None,
         "preTotalGeneration": 99.0, "MD001": -1.0, "TheoreticalGeneration": 0.0},
    )
    row = reports.combined(reports.window_totals(rows)).first()
    assert row.Count == 0
    assert row.Availability == 0.5 and row.InterruptionDurationCalculated == 598.0
    assert row.MTBFDuration is None and row.MTTRDuration is None
    assert row.EquivalentHours is None and row.FullLoadDurationDay == 1.0
    assert row.GriActiveEnergyDelTotal == 0.0
    # the last row has no meter value, so no energy is known
    assert row.EnergyAvailability is None and row.Discrepancy is None


def test_discrepancy_without_the_limit_cause(spark, telemetry):
    losses = dict.fromkeys(metrics.LOSSES, 0.0) | {"FaultLossGeneration": 3600.0, "LimitLossGeneration": 7200.0}
    rows = _samples(spark, telemetry, {"MC006": 10.0, "preTotalGeneration": 7.0, "TheoreticalGeneration": 36000.0, **losses})
    row = reports.efficiency(reports.window_totals(rows)).first()
    assert row.Discrepancy == pytest.approx((1 - 3 / 4) * 100)
    assert row.EnergyAvailability == pytest.approx(3 / 36000 * 3600 * 100)
    assert row.LimitLossGeneration == pytest.approx(7200 / 3600 / 10000)


def test_ad_hoc_names_and_counts(totals):
    made = reports.ad_hoc_rows(totals, "SummaryReport")
    assert "YawHoursTotal" in made.columns and "YawHours" not in made.columns
    with pytest.raises(ValueError):
        reports.ad_hoc_rows(totals, "Other")
