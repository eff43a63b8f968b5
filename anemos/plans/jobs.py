"""Whole jobs: sources, operators and sinks put together."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import naive
from ..operators import availability, blocks, conditions, energy, events, metrics, reports, rollup, schemas
from ..operators.resample import of_devices
from ..session import materialize
from ..sinks import csv, tables
from ..sinks.snapshots import snapshot
from . import upkeep


def merge_files(spark: SparkSession, first: str | None, second: str, target: str, by: str = "time") -> None:
    """Merge two Parquet tables by column name into ``target``, in time order.

    Without a first table, or with a path where there is none, the second is taken as it is. The target is a table
    with a log (:mod:`anemos.sinks.snapshots`), replaced in one commit, so it may be an input, too: until then, and
    after a failure, it has its old rows. If another job changes it meanwhile, the merge is an error.
    """
    base = snapshot(spark, target)
    merged = tables.stored_rows(spark, second)
    if merged is None:
        raise FileNotFoundError(second)
    earlier = tables.stored_rows(spark, first) if first is not None else None
    if earlier is not None:
        merged = schemas.merge_by_name(earlier, merged)
    tables.write_sorted(merged, target, by, base=base)


def ten_minute_reports(samples: DataFrame) -> dict[str, DataFrame]:
    """The three report tables of all samples, from one pass over them."""
    totals = materialize(reports.window_totals(samples), "report-totals")
    return _split(totals)


def arrival_reports(arrivals: DataFrame) -> dict[str, DataFrame]:
    """The three report tables of arriving files, from :func:`anemos.sources.scan_arrivals`."""
    totals = materialize(reports.file_totals(arrivals), "report-totals")
    return _split(totals)


def _split(totals: DataFrame) -> dict[str, DataFrame]:
    return {
        "SummaryReport": reports.summary(totals),
        "TurbineAvailabilityMetrics": reports.availability(totals),
        "EfficiencyMetrics": reports.efficiency(totals),
    }


def store_reports(tables_by_kind: Mapping[str, DataFrame], store: str, zero_nulls: bool = False) -> None:
    """Write report tables to the store, replacing the days they hold."""
    for kind, rows in tables_by_kind.items():
        tables.write_report_store(rows, store, kind, zero_nulls)


def merge_reports(tables_by_kind: Mapping[str, DataFrame], store: str, zero_nulls: bool = False) -> None:
    """Add report rows to the store, replacing those of the same device and time."""
    for kind, rows in tables_by_kind.items():
        tables.merge_report_store(rows, store, kind, zero_nulls)


def ad_hoc_slices(samples: DataFrame, kind: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """One report row per turbine and day of ``start`` … ``end`` (end excluded).

    Slices are days cut to the range, so the day is found by arithmetic and the
    range bounds are plain filters that reach the scan.
    """
    if kind not in metrics.REPORT_COLUMNS:
        raise ValueError(f"unknown report {kind!r}")
    picked = samples.where((F.col("time") >= naive(start)) & (F.col("time") < naive(end)))
    if "dt" in samples.columns:
        picked = picked.where(F.col("dt").between(F.lit(start.date()), F.lit(end.date())))
    return reports.ad_hoc_rows(reports.window_totals(picked, "1 DAY"), kind)


def ad_hoc_report(
    samples: DataFrame, kind: str, groups: rollup.Groups, start: dt.datetime, end: dt.datetime,
    formulas: Mapping[str, str] | None = None,
) -> DataFrame:
    """A report straight from samples: one row per group for the whole range.

    Slices without samples contribute nothing; a group without any keeps a row.
    """
    devices = [device for item in groups for names in item.values() for device in names]
    picked = of_devices(samples, devices)
    return rollup.ad_hoc_rollup(ad_hoc_slices(picked, kind, start, end), groups, start, formulas)


def stored_report(
    rows: DataFrame, groups: rollup.Groups, period: str, start: dt.datetime, end: dt.datetime,
    columns: Sequence[str] | None = None, formulas: Mapping[str, str] | None = None, rules: str = "by_name",
) -> DataFrame:
    """Stored ten-minute rows rolled up per group and period, in output order."""
    if "dt" in rows.columns:
        rows = rows.where(F.col("dt").between(F.lit(_before(start, period)), F.lit(_after(end, period)))).drop("dt")
    rows = of_devices(rows, [device for item in groups for names in item.values() for device in names], "DeviceName")
    return rollup.rollup(rows, groups, period, start, end, columns, formulas, rules).orderBy("group_ord", "Time")


def exact_report(
    spark: SparkSession, store: str, groups: rollup.Groups, period: str, start: dt.datetime, end: dt.datetime,
    columns: Sequence[str], formulas: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stored blocks rolled up per group and period, each value as the samples would give it, in output order."""
    stored = upkeep.scan_blocks(
        spark, store, dt.datetime.combine(_before(start, period), dt.time()), dt.datetime.combine(_after(end, period), dt.time()))
    return blocks.exact_rollup(stored, groups, period, start, end, columns, formulas).orderBy("group_ord", "Time")


def exact_range_report(
    spark: SparkSession, store: str, groups: rollup.Groups, start: dt.datetime, end: dt.datetime,
    columns: Sequence[str], formulas: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per group for a range that begins and ends on ten minutes, from the fewest stored blocks."""
    stored = upkeep.scan_blocks(spark, store, start, end)
    return blocks.exact_range(stored, groups, start, end, columns, formulas).orderBy("group_ord")


def _before(start: dt.datetime, period: str) -> dt.date:
    """The first day of the period that holds ``start``."""
    return start.date().replace(day=1) if period in ("month", "year") else start.date()


def _after(end: dt.datetime, period: str) -> dt.date:
    """A date no period that holds ``end`` reaches beyond."""
    longest = {"month": 31, "year": 366}.get(period, 1)
    return end.date() + dt.timedelta(days=longest)


def tba(samples: DataFrame, first: dt.date, last: dt.date, farm: str = "farm") -> DataFrame:
    """Minutes per turbine, day and condition over the days of a request."""
    samples = _of_days(samples, first, last)
    minutes = materialize(availability.daily_minutes(conditions.condition_sums(samples, "1 DAY")), "daily-minutes")
    return availability.availability_calendar(minutes, first, last, farm)


def _of_days(samples: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Samples of the days of a request, both included."""
    day = dt.timedelta(days=1)
    picked = samples.where(
        (F.col("time") >= naive(dt.datetime.combine(first, dt.time())))
        & (F.col("time") < naive(dt.datetime.combine(last + day, dt.time()))))
    return picked.where(F.col("dt").between(F.lit(first), F.lit(last))) if "dt" in samples.columns else picked


def pba_rows(sums: DataFrame, info: DataFrame, curve_points: DataFrame,
             international: DataFrame | None = None, fit: str = "line") -> DataFrame:
    """Five-minute and ten-minute rows with expected energy, as a table."""
    both = energy.five_minute_rows(sums).unionByName(energy.ten_minute_rows(sums))
    return materialize(energy.with_expected(both, info, curve_points, international, fit), "energy-rows")


def tba_and_pba(
    samples: DataFrame, info: DataFrame, curve_points: DataFrame, first: dt.date, last: dt.date,
    farm: str = "farm", international: DataFrame | None = None, fit: str = "line",
) -> tuple[DataFrame, DataFrame]:
    """Both availability tables of the days of a request. Samples are read once: everything is made from
    the sums per turbine, five minutes and label.

    ``fit`` tells how curves are read between their points: along straight lines, or
    through a regression forest (``"forest"``).
    """
    samples = _of_days(samples, first, last)
    sums = materialize(conditions.condition_sums(samples), "condition-sums")
    minutes = materialize(availability.daily_minutes(sums), "daily-minutes")
    rows = pba_rows(sums, info, curve_points, international, fit)
    return (
        availability.availability_calendar(minutes, first, last, farm),
        energy.daily_energy(energy.with_potential(rows), farm),
    )


def export_events(messages: DataFrame, query: events.EventQuery, columns: Sequence[Mapping[str, str]],
                  path: str, realtime: bool = False) -> None:
    """Filter, flatten and decode event messages and write them as CSV.

    Conditions and the page apply to messages; related events come along.
    """
    events.check_columns(columns)
    found = events.open_events(messages, query) if realtime else events.history(messages, query)
    flat = events.flatten_nested(found) if "Relevant" in found.columns else found
    csv.write_layout(csv.event_layout(events.decode(flat), columns), path)
