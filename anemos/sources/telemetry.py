"""Readers of per-second telemetry."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.buckets import naive
from ..functions.filenames import device_of, sample_time_of
from ..operators.resample import in_range
from ..sinks.snapshots import is_table, read_table


def _reader(spark: SparkSession, schema: T.StructType | None, merge_schema: bool = False) -> DataFrameReader:
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    return reader if schema is None else reader.schema(schema)


def scan_telemetry(
    spark: SparkSession,
    base: str,
    *,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    devices: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Samples of a table partitioned by ``dt`` (a date), both range ends included.

    The range also bounds ``dt``, so files of other days are not read; time and
    turbine filters reach the Parquet scan. Where files differ, give ``schema``:
    columns a file lacks are null. ``merge_schema`` finds it out instead, at the
    price of reading all footers first. A table with a log (:mod:`anemos.sinks.snapshots`) needs neither: the log has the
    schema, and names the files of the range.
    """
    if is_table(spark, base):
        df = read_table(spark, base, start, end)
    else:
        df = _reader(spark, schema, merge_schema).parquet(base)
    if "dt" in df.columns:
        if start is not None:
            df = df.where(F.col("dt") >= F.lit(start.date()))
        if end is not None:
            df = df.where(F.col("dt") <= F.lit(end.date()))
    return in_range(df, start, end, devices)


def scan_device_day(df: DataFrame, device: str, day: dt.date) -> DataFrame:
    """Samples of one turbine on one day."""
    if "dt" in df.columns:
        df = df.where(F.col("dt") == F.lit(day))
    from_day = dt.datetime.combine(day, dt.time())
    next_day = naive(from_day + dt.timedelta(days=1))
    return in_range(df, from_day, None, [device]).where(F.col("time") < next_day)


def day_folder_glob(base: str, days: Sequence[dt.date], devices: Sequence[str] | None = None) -> str:
    """The glob ``<base>/{yyyyMMdd,…}/{device,…}*.parquet``."""
    if not days or devices is not None and not devices:
        raise ValueError("no days or no devices to read")
    folders = ",".join(f"{day:%Y%m%d}" for day in days)
    names = "{" + ",".join(f"{device}*" for device in devices) + "}" if devices else "*"
    return f"{base.rstrip('/')}/{{{folders}}}/{names}.parquet"


def scan_day_folders(
    spark: SparkSession,
    base: str,
    first: dt.date,
    last: dt.date,
    devices: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Samples of the layout ``<base>/<yyyyMMdd>/<device>*.parquet``.

    Only folders of the days and files of the devices asked for are listed.
    """
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    df = _reader(spark, schema, merge_schema).parquet(day_folder_glob(base, days, devices))
    return df.select(*columns) if columns else df


def scan_files_named(spark: SparkSession, folder: str, part: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet files directly in ``folder`` whose name holds ``part``."""
    df = spark.read.option("pathGlobFilter", f"*{part}*.parquet").parquet(folder)
    return df.select(*columns) if columns else df


def with_file_keys(df: DataFrame) -> DataFrame:
    """Add path, device and sample time of the file each row comes from. Works on
    a DataFrame read straight from files, in batch or as a stream."""
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        path.alias("file_path"),
        device_of(F.col("_metadata.file_name")).alias("file_device"),
        sample_time_of(path).alias("file_time"),
    )


def scan_arrivals(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """Arriving files with the device and sample time their names tell."""
    return with_file_keys(_reader(spark, schema).parquet(*paths))
