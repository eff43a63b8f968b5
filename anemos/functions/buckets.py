"""Time buckets and the number of the period a time falls into.

Times are ``timestamp_ntz`` and everything is reckoned without a zone. Buckets
start at 1970-01-01 for minutes, hours and days, at Monday 1970-01-05 for weeks,
and count whole months since 1970-01 for months, quarters and years.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTERVAL = re.compile(r"^(\d+)\s+(MINUTE|HOUR|DAY|WEEK|MONTH|QUARTER|YEAR)$", re.IGNORECASE)
_MONTHS_PER_UNIT = {"MONTH": 1, "QUARTER": 3, "YEAR": 12}


def parse_interval(text: str) -> tuple[int, str]:
    """``"10 minute"`` → ``(10, "MINUTE")``; anything else is an error."""
    match = _INTERVAL.match(text.strip())
    if not match or int(match.group(1)) == 0:
        raise ValueError(f"not a resample interval: {text!r}")
    return int(match.group(1)), match.group(2).upper()


def month_number(time: Column) -> Column:
    """Whole months since 1970-01."""
    return (F.year(time) - 1970) * 12 + F.month(time) - 1


def month_start(months: Column) -> Column:
    """The first instant of a month given as months since 1970-01."""
    return F.add_months(F.expr("DATE'1970-01-01'"), months).cast("timestamp_ntz")


def time_bucket(time: Column | str, interval: str) -> Column:
    """Start of the bucket of width ``interval`` that holds ``time``.

    Spark allows one window expression per projection; take several buckets in
    several ``withColumn`` steps.
    """
    time = F.col(time) if isinstance(time, str) else time
    count, unit = parse_interval(interval)
    if unit in _MONTHS_PER_UNIT:
        width = count * _MONTHS_PER_UNIT[unit]
        number = month_number(time)
        return month_start((number - F.pmod(number, F.lit(width))).cast("int"))
    width = f"{count} {unit.lower()}s"
    if unit == "WEEK":
        return F.window(time, width, width, "4 days")["start"]
    return F.window(time, width)["start"]


def naive(moment: dt.datetime) -> Column:
    """A Python datetime as a zone-free literal."""
    return F.lit(moment.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
