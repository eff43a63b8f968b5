"""Reports and blocks kept up with a table of samples that changes.

Whatever a batch of samples touches is made anew from the table: the ten-minute blocks of the
windows it has samples of, late or not, then the hours, days and months that hold them, and the
report rows of the windows. So the stores always are what one run over all samples would make,
in whatever order samples came, and a batch that runs again changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import time_bucket
from ..operators import blocks, metrics, reports
from ..session import materialize, scratch_scope
from ..sinks import tables
from ..sinks.snapshots import read_table

BLOCKS, FILE_BLOCKS = "Blocks", "FileBlocks"


def _level_path(store: str, level: str) -> str:
    return f"{store.rstrip('/')}/{BLOCKS}/{level}"


def _sliced(rows: DataFrame, level: str) -> DataFrame:
    """Short blocks lie in a folder per day, days in one per month and months in one per year."""
    unit = {"day": "MONTH", "month": "YEAR"}.get(level)
    day = F.date_trunc(unit, "Time").cast("timestamp_ntz") if unit else F.col("Time")
    return rows.withColumn("_slice", day)


def _merge_level(rows: DataFrame, store: str, level: str, keys: DataFrame | None = None) -> None:
    touched = None if keys is None else _sliced(keys, level)
    tables.merge_slices(_sliced(rows, level), _level_path(store, level), list(reports.KEYS), "_slice", touched=touched)


def scan_blocks(spark: SparkSession, store: str, start: dt.datetime | None = None, end: dt.datetime | None = None) -> dict[str, DataFrame]:
    """The stored blocks by level. With a range only the folders of its days (months, years) are opened."""
    found = {}
    for level in blocks.LEVELS:
        low = start and {"day": start.replace(day=1), "month": start.replace(month=1, day=1)}.get(level, start)
        low = low and low.replace(hour=0, minute=0, second=0, microsecond=0)
        rows = read_table(spark, _level_path(store, level), low, end)
        if rows is not None:
            found[level] = rows.drop("_slice", "dt")
    return found


def store_blocks(samples: DataFrame, store: str) -> None:
    """Make the blocks of all levels from all samples; days that the samples have are replaced."""
    with scratch_scope(samples.sparkSession):
        rows = materialize(blocks.sample_blocks(samples), "blocks")
        tables.commit_slices(_sliced(rows, "10min"), _level_path(store, "10min"), "_slice")
        for level in list(blocks.LEVELS)[1:]:
            rows = materialize(blocks.longer_blocks(rows, level), f"blocks-{level}")
            tables.commit_slices(_sliced(rows, level), _level_path(store, level), "_slice")


def touched_windows(samples: DataFrame) -> DataFrame:
    """The turbines and ten-minute windows (DeviceName, Time) that samples fall into."""
    return samples.select(
        time_bucket("time", blocks.LEVELS["10min"]).alias("Time"), F.col("turbine").alias("DeviceName")).distinct()


def redo_windows(windows: DataFrame, table: str, store: str, zero_nulls: bool = False,
                 kinds: Sequence[str] = tuple(metrics.REPORT_COLUMNS)) -> None:
    """Make the blocks and reports of some windows (Time, DeviceName) anew from the table of samples.

    Only the days of the windows are read of it, and of the blocks only what lies in the
    hours, days and months around them. ``windows`` is read several times: pass a table.
    """
    spark = windows.sparkSession
    days = [row["dt"] for row in windows.select(F.to_date("Time").alias("dt")).distinct().collect()]
    samples = read_table(spark, table)
    if not days or samples is None:
        return
    with scratch_scope(spark):
        samples = samples.where(F.col("dt").isin(days)).drop("dt", "hr")
        samples = samples.withColumn("_window", time_bucket("time", blocks.LEVELS["10min"]))
        touched = windows.select(F.col("Time").alias("_window"), F.col("DeviceName").alias("turbine"))
        samples = samples.join(touched, ["_window", "turbine"], "left_semi").drop("_window")
        rows = materialize(blocks.sample_blocks(samples), "blocks")
        _merge_reports(rows, store, zero_nulls, kinds, lambda: _merge_level(rows, store, "10min"))
        levels = list(blocks.LEVELS)
        for shorter, level in zip(levels, levels[1:]):
            keys = windows.select(time_bucket("Time", blocks.LEVELS[level]).alias("Time"), "DeviceName").distinct()
            _merge_level(blocks.longer_blocks(_blocks_of(spark, store, shorter, keys, level), level), store, level, keys)


def _merge_reports(rows: DataFrame, store: str, zero_nulls: bool, kinds: Sequence[str], *others: Callable[[], None]) -> None:
    """Reports of ten-minute blocks into their tables, all at the same time, as these do not depend on each other."""
    made = blocks.block_reports(rows)

    def merge(kind: str) -> None:
        tables.merge_report_store(made.select(*metrics.REPORT_COLUMNS[kind]), store, kind, zero_nulls)

    jobs = [*others, *(lambda kind=kind: merge(kind) for kind in kinds)]
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(inheritable_thread_target(rows.sparkSession)(job)) for job in jobs]:
            done.result()


def _blocks_of(spark: SparkSession, store: str, shorter: str, keys: DataFrame, level: str) -> DataFrame:
    """Stored blocks of a level that lie in the longer blocks named."""
    first, last = keys.agg(F.min("Time"), F.max("Time")).first()
    end = last + {"hour": dt.timedelta(hours=1), "day": dt.timedelta(days=1), "month": dt.timedelta(days=31)}[level]
    rows = scan_blocks(spark, store, first, end)[shorter]
    rows = rows.withColumn("_block", time_bucket("Time", blocks.LEVELS[level]))
    return rows.join(keys.withColumnRenamed("Time", "_block"), ["_block", "DeviceName"], "left_semi").drop("_block")


def redo_late(spark: SparkSession, late_folder: str, table: str, store: str, after_batch: int = -1, zero_nulls: bool = False) -> int:
    """Redo the windows of the samples that :func:`anemos.streaming.merge_arrivals` listed as late.

    ``after_batch`` leaves out batches up to that number; the number of the newest listed is returned, for the next call.
    """
    late = tables.stored_rows(spark, f"{late_folder}/samples")
    if late is None:
        return after_batch
    late = late.where(F.col("batch") > after_batch)
    with scratch_scope(spark):
        windows = materialize(touched_windows(late), "late-windows")
        redo_windows(windows, table, store, zero_nulls)
    newest = late.agg(F.max("batch")).first()[0]
    return after_batch if newest is None else newest


def merge_file_reports(arrivals: DataFrame, store: str, zero_nulls: bool = False) -> None:
    """Reports of arriving files (:func:`anemos.sources.scan_arrivals`) into the report store.

    What a file adds to its device and ten minutes is kept by file, and a report is made from all files of its
    device and time, whenever they came. A file that comes again replaces what it added before.
    """
    spark = arrivals.sparkSession
    path = f"{store.rstrip('/')}/{FILE_BLOCKS}"
    with scratch_scope(spark):
        fresh = materialize(blocks.file_blocks(arrivals), "file-blocks")
        tables.merge_slices(fresh, path, ["Time", "DeviceName", "file_path"], "Time")
        first, last = fresh.agg(F.min("Time"), F.max("Time")).first()
        if first is None:
            return
        every = read_table(spark, path, first, last).join(fresh.select(*reports.KEYS).distinct(), list(reports.KEYS), "left_semi")
        rows = blocks.merged_blocks(every, *reports.KEYS).withColumn("_windows", F.lit(1).cast("bigint"))
        _merge_reports(materialize(rows, "file-reports"), store, zero_nulls, list(metrics.REPORT_COLUMNS))
