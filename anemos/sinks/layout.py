"""Tables laid out by turbine and time at once, so that a reader of some turbines opens few row groups.

Rows of a day are put in the order of a key that takes the bits of the turbine's place among all
turbines and of the time of day in turns (a Z curve). Row groups then hold a narrow range of turbines as well as of
times, their footers say so, and the filters that reach the scan leave the others out. A table that grew by
many small commits is put in order day by day with :func:`recluster`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .snapshots import Snapshot, commit, open_files, snapshot

BITS = 12
TIME_BITS = 2


def curve_key(first: Column, second: Column, bits: int = BITS, second_bits: int = TIME_BITS) -> Column:
    """A key that orders by both numbers: the bits of the first (``bits`` long) and the second (``second_bits`` long) in turns, high bits first."""
    key, place = F.lit(0).cast("long"), bits + second_bits
    one, two = first.cast("long"), second.cast("long")
    for at in range(max(bits, second_bits)):
        for value, length in ((one, bits), (two, second_bits)):
            if at < length:
                place -= 1
                bit = F.shiftright(value, length - 1 - at).bitwiseAND(F.lit(1).cast("long"))
                key = key.bitwiseOR(F.shiftleft(bit, place))
    return key


def _placed(rows: DataFrame, time: str, device: str) -> DataFrame:
    """Rows with their key: the place of the device among all, and the part of the day."""
    names = rows.select(F.col(device).alias("_device")).distinct()
    # One row per device, so one task can number them.
    ordered = names.select("_device", (F.row_number().over(Window.orderBy("_device")) - 1).alias("_place"))
    spread = ordered.select("_device", F.floor(F.col("_place") * (1 << BITS) / F.count(F.lit(1)).over(Window.partitionBy())).alias("_place"))
    second = F.unix_timestamp(F.col(time).cast("timestamp")) % 86400
    part = F.floor(second * (1 << TIME_BITS) / 86400)
    joined = rows.join(spread, rows[device].eqNullSafe(spread["_device"]), "left")
    return joined.withColumn("_key", curve_key(F.coalesce("_place", F.lit(0)), F.coalesce(part, F.lit(0)))).drop("_device", "_place")


def commit_clustered(rows: DataFrame, path: str, time: str = "time", device: str = "turbine", files: int | None = None,
                     base: Snapshot | None = None, options: Mapping[str, str] | None = None) -> Snapshot:
    """Replace the days that ``rows`` has, in one commit, by rows in the order of the key, over and within the files.

    ``files`` is about the number of files in all; ``options`` go to the Parquet writer (``parquet.block.size`` is the size of a row group).
    """
    placed = _placed(rows.withColumn("dt", F.to_date(time)), time, device)
    ranged = placed.repartitionByRange(files, "dt", "_key") if files else placed.repartitionByRange("dt", "_key")
    ordered = ranged.sortWithinPartitions("dt", "_key", device, time).select(*rows.columns, "dt")
    return commit(ordered, path, time, ["dt"], "slices", base, options=options)


def recluster(spark: SparkSession, path: str, first: dt.date, last: dt.date, time: str = "time", device: str = "turbine",
              files: int | None = None, options: Mapping[str, str] | None = None) -> Snapshot | None:
    """Put the days from ``first`` to ``last`` of a table with a log in the order of the key, in one commit.

    Its rows stay as they are; if another writer changes one of the days meanwhile, nothing is written and it is an error.
    """
    state = snapshot(spark, path)
    if state is None:
        return None
    days = {f"dt={first + dt.timedelta(days=n)}" for n in range((last - first).days + 1)}
    found = [file for name, part in state.files.items() if name in days for file in part]
    if not found:
        return state
    return commit_clustered(open_files(spark, path, state, found).drop("dt"), path, time, device, files, state, options)
