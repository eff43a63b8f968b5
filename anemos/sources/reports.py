"""Reader of the report store."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import naive
from ..operators.metrics import REPORT_COLUMNS
from ..operators.resample import of_devices
from ..sinks.snapshots import read_table


def report_rows(df: DataFrame, columns: Sequence[str], devices: Sequence[str],
                start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Chosen columns of report rows of some devices, from ``start`` until before ``end``."""
    if "dt" in df.columns:
        df = df.where(F.col("dt").between(F.lit(start.date()), F.lit(end.date())))
    picked = df.where((F.col("Time") >= naive(start)) & (F.col("Time") < naive(end)))
    return of_devices(picked, devices, "DeviceName").select(*columns)


def scan_reports(spark: SparkSession, store: str, kind: str) -> DataFrame:
    """All rows of one report kind, with the partition column ``dt``."""
    if kind not in REPORT_COLUMNS:
        raise ValueError(f"unknown report {kind!r}; use one of {', '.join(REPORT_COLUMNS)}")
    rows = read_table(spark, f"{store.rstrip('/')}/{kind}")
    if rows is None:
        raise FileNotFoundError(f"{store} has no {kind}")
    return rows
