"""Signals resampled to time buckets per turbine."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import naive, parse_interval, time_bucket
from ..session import small_table

AGGREGATES: dict[str, Callable[[str], Column]] = {
    "avg": F.avg,
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
    "count": F.count,
    "first": lambda signal: F.min_by(signal, "time"),
    "last": lambda signal: F.max_by(signal, "time"),
}


def of_devices(df: DataFrame, devices: Sequence[str], column: str = "turbine") -> DataFrame:
    """Rows of the given devices; an empty list keeps nothing."""
    wanted = list(dict.fromkeys(devices))
    if not wanted:
        return df.where(F.lit(False))
    return df.where(F.col(column).isin(*wanted))


def in_range(df: DataFrame, start: dt.datetime | None, end: dt.datetime | None,
             devices: Sequence[str] | None) -> DataFrame:
    """Samples of the given turbines from ``start`` to ``end``, both included.

    ``None`` leaves a condition out; an empty device list keeps nothing.
    """
    if start is not None:
        df = df.where(F.col("time") >= naive(start))
    if end is not None:
        df = df.where(F.col("time") <= naive(end))
    return df if devices is None else of_devices(df, devices)


def aggregate_columns(signals: Mapping[str, Sequence[str]], columns: Sequence[str],
                      titles: Mapping[str, str]) -> dict[str, Column]:
    """One column per requested signal and aggregate, named title + aggregate.

    Requested columns without an aggregate are left out.
    """
    result = {}
    for column in columns:
        for name in signals.get(column, ()):
            if name.lower() not in AGGREGATES:
                raise ValueError(f"unknown aggregate {name!r}; use one of {', '.join(AGGREGATES)}")
            result[titles.get(column, column) + name] = AGGREGATES[name.lower()](column)
    if not result:
        raise ValueError("no column with an aggregate was requested")
    return result


def resample(
    df: DataFrame,
    every: str,
    signals: Mapping[str, Sequence[str]],
    *,
    columns: Sequence[str] | None = None,
    titles: Mapping[str, str] | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    devices: Sequence[str] | None = None,
) -> DataFrame:
    """Aggregates of signals per bucket and turbine, ordered by both."""
    parse_interval(every)
    aggregates = aggregate_columns(signals, columns or list(signals), titles or {})
    return (
        in_range(df, start, end, devices)
        .groupBy(time_bucket("time", every).alias("interval"), "turbine")
        .agg(*[column.alias(name) for name, column in aggregates.items()])
        .orderBy("interval", "turbine")
        .select("interval", *aggregates, "turbine")
    )
