"""Summary, availability and efficiency reports from per-second telemetry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import time_bucket
from ..functions.filenames import ten_minutes_of
from . import metrics

KEYS = ("Time", "DeviceName")


def window_totals(df: DataFrame, every: str = "10 MINUTE") -> DataFrame:
    """Totals per turbine and time window, in one pass over the samples.

    Grouping by turbine *and* window keeps a busy turbine spread over many
    groups, and every aggregate is combined before the shuffle.
    """
    keys = [time_bucket("time", every).alias("Time"), F.col("turbine").alias("DeviceName")]
    return _aggregate(df, keys)


def file_totals(arrivals: DataFrame) -> DataFrame:
    """Totals per device and report of arriving files, told by their names.

    ``arrivals`` has the file keys of :func:`anemos.sources.with_file_keys`. A path
    without twelve digits in a row is an error, as its rows belong to no report.
    """
    return _aggregate(arrivals, file_keys())


def file_keys() -> list[Column]:
    """Report time and device of rows with the file keys; a path without a time is an error."""
    unknown = F.raise_error(F.concat(F.lit("no report time in path "), F.col("file_path")))
    time = F.coalesce(ten_minutes_of(F.col("file_time")), unknown.cast("timestamp_ntz"))
    return [time.alias("Time"), F.col("file_device").alias("DeviceName")]


def _aggregate(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*total_columns())


def total_columns() -> list[Column]:
    """The aggregates of a window; those a report does not use are pruned by Spark."""
    return [F.expr(f"{aggregate} AS {name}") for name, aggregate in metrics.totals().items()]


def report_of(totals: DataFrame, columns: Sequence[str], count: str = "Count",
              formulas: Mapping[str, str] | None = None) -> DataFrame:
    """Report columns from totals, by ``formulas`` (those of a window, unless given)."""
    formulas = metrics.derived() if formulas is None else formulas

    def column(name: str) -> str:
        if name in KEYS:
            return f"`{name}`"
        if name == "Count":
            return f"{count} AS Count"
        return f"CAST({formulas.get(name, name)} AS DOUBLE) AS {name}"

    return totals.selectExpr(*[column(name) for name in columns])


def summary(totals: DataFrame) -> DataFrame:
    """The 54-column summary report."""
    return report_of(totals, metrics.SUMMARY_COLUMNS)


def availability(totals: DataFrame) -> DataFrame:
    """The 32-column availability report."""
    return report_of(totals, metrics.AVAILABILITY_COLUMNS)


def efficiency(totals: DataFrame) -> DataFrame:
    """The 13-column efficiency report."""
    return report_of(totals, metrics.EFFICIENCY_COLUMNS)


def combined(totals: DataFrame) -> DataFrame:
    """All three reports side by side, computed in one aggregate."""
    return report_of(totals, metrics.COMBINED_COLUMNS)


# What ``Count`` counts when a report is made straight from samples.
_AD_HOC_COUNT = {
    "SummaryReport": "Count",
    "TurbineAvailabilityMetrics": "_rows",
    "EfficiencyMetrics": "_energy_rows",
}


def ad_hoc_rows(totals: DataFrame, kind: str) -> DataFrame:
    """One report kind as the ad hoc form has it.

    It differs from the stored form in what ``Count`` counts, and in calling the
    yaw seconds ``YawHoursTotal``, which makes a merge add them up.
    """
    if kind not in _AD_HOC_COUNT:
        raise ValueError(f"unknown report {kind!r}")
    rows = report_of(totals, metrics.REPORT_COLUMNS[kind], _AD_HOC_COUNT[kind])
    return rows.withColumnRenamed("YawHours", "YawHoursTotal")
