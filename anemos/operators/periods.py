"""Period grids: the time axis of a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import month_number, month_start

# Report periods, the unit their start is cut to, and their length.
PERIODS = {
    "10min": ("MINUTE", "INTERVAL '10' MINUTE"),
    "hour": ("HOUR", "INTERVAL '1' HOUR"),
    "day": ("DAY", "INTERVAL '1' DAY"),
    "month": ("MONTH", "INTERVAL '1' MONTH"),
    "year": ("MONTH", "INTERVAL '1' YEAR"),
}
_SECONDS = {"10min": 600, "hour": 3600, "day": 86400}
_MONTHS = {"month": 1, "year": 12}


def _lookup(period: str) -> tuple[str, str]:
    if period not in PERIODS:
        raise ValueError(f"unknown report period {period!r}; use one of {', '.join(PERIODS)} or 'time'")
    return PERIODS[period]


def grid_start(start: Column, period: str) -> Column:
    """The start of a request cut to the minute, hour, day or month."""
    return F.date_trunc(_lookup(period)[0], start).cast("timestamp_ntz")


def period_grid(df: DataFrame, period: str, start: str = "start", end: str = "end") -> DataFrame:
    """One row per input row and period from ``start`` until ``end`` is covered.

    Adds ``period_start`` and ``period_end``. The last period may pass ``end``.
    """
    step = F.expr(_lookup(period)[1])
    first = grid_start(F.col(start), period)
    last = F.col(end) - F.expr("INTERVAL '1' MICROSECOND")
    starts = F.when(first < F.col(end), F.sequence(first, last, step))
    return df.withColumn("period_start", F.explode(starts)).withColumn("period_end", F.col("period_start") + step)


def day_grid(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per input row and slice: the request cut at every midnight."""
    day = F.expr("INTERVAL '1' DAY")
    first = F.date_trunc("DAY", F.col(start)).cast("timestamp_ntz")
    last = F.col(end) - F.expr("INTERVAL '1' MICROSECOND")
    days = F.when(F.col(start) < F.col(end), F.sequence(first, last, day))
    cut = df.withColumn("_day", F.explode(days))
    return cut.select(
        *df.columns,
        F.greatest(F.col(start), F.col("_day")).alias("period_start"),
        F.least(F.col(end), F.col("_day") + day).alias("period_end"),
    )


def period_of(time: Column, start: Column, period: str) -> Column:
    """The start of the period of the grid beginning at ``start`` that holds ``time``.

    Plain arithmetic, so rows find their period without a range join.
    """
    first = grid_start(start, period)
    if period in _SECONDS:
        width = _SECONDS[period]
        seconds = F.unix_seconds(time.cast("timestamp")) - F.unix_seconds(first.cast("timestamp"))
        passed = F.floor(seconds / F.lit(width)) * width
        return first + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), passed.cast("decimal(18,6)"))
    width = _MONTHS[period]
    months = month_number(time) - month_number(first)
    return month_start((month_number(first) + months - F.pmod(months, F.lit(width))).cast("int"))
