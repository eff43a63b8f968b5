"""Keys that live in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two patterns file names follow.
DEVICE_PATTERN = r"^([A-Z0-9]+)_([0-9]+)_"
TIME_PATTERN = r"\d{12}"


def device_of(file_name: Column) -> Column:
    """``WF01_001_….parquet`` → ``WF01_001``; null where the name does not fit."""
    farm = F.regexp_extract(file_name, DEVICE_PATTERN, 1)
    number = F.regexp_extract(file_name, DEVICE_PATTERN, 2)
    return F.when(farm != "", F.concat_ws("_", farm, number))


def sample_time_of(path: Column) -> Column:
    """The first twelve digits of a path read as ``yyyyMMddHHmm``."""
    digits = F.nullif(F.regexp_extract(path, TIME_PATTERN, 0), F.lit(""))
    return F.to_timestamp_ntz(digits, F.lit("yyyyMMddHHmm"))


def ten_minutes_of(time: Column) -> Column:
    """Start of the ten minutes that hold ``time``, without a window expression."""
    minutes = F.floor(F.minute(time) / 10) * 10
    return F.date_trunc("HOUR", time).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def report_time_of(path: Column) -> Column:
    """The ten-minute report a file belongs to."""
    return ten_minutes_of(sample_time_of(path))
