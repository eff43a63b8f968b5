"""A table of events with a stored pyramid of counts, from which late pages are found without counting events.

The index holds how many events there are per combination of filter fields and minute, and per combination and day.
A batch of events adds to both in one commit each, once, however often it runs. A page reads the counts
of days, those of the minutes of the days it touches, and the events of its own minutes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import naive
from ..operators import events as ev
from ..session import materialize, scratch_scope
from ..sinks import tables
from ..sinks.snapshots import Snapshot, commit, open_files, read_table, snapshot

# The fields that a query can ask for.
FIELDS = ("System", "Category", "FarmCode", "Device", "EventLevel", "FirstEvent", "Confirmed")
UNITS = {"minute": "MINUTE", "day": "DAY"}
STREAM = "events"


def _path(store: str, name: str) -> str:
    return f"{store.rstrip('/')}/{name}"


def add_events(batch: DataFrame, store: str, batch_id: int, stream: str = STREAM) -> None:
    """Add a batch of decoded events, with times as timestamps, to the table and its index; a batch that is there already changes nothing."""
    spark, mark = batch.sparkSession, (stream, batch_id)
    with scratch_scope(spark):
        rows = materialize(batch, "event-batch")
        # An event without a start has a folder of its own.
        dated = rows.withColumn("dt", F.to_date("StartTime")).hint("rebalance", "dt")
        commit(dated, _path(store, "events"), "StartTime", ["dt"], "nothing", mark=mark)
        for name, unit in UNITS.items():
            fresh = rows.groupBy(*FIELDS, F.date_trunc(unit, "StartTime").cast("timestamp_ntz").alias("StartTime")).agg(
                F.count(F.lit(1)).alias("n"))
            _add_counts(materialize(fresh, f"event-{name}s"), _path(store, name), unit, mark)


def _add_counts(fresh: DataFrame, path: str, unit: str, mark: tuple[str, int]) -> None:
    """Add counts to those of the same fields and time. Counts of minutes lie in a folder per day, of days in one per month."""
    spark = fresh.sparkSession
    fresh = fresh.withColumn("dt", F.to_date("StartTime" if unit == "MINUTE" else F.date_trunc("MONTH", "StartTime")))
    state = snapshot(spark, path) or Snapshot(-1, fresh.drop("dt").schema, ("dt",), "StartTime", {}, {})
    slices = [f"dt={row['dt'] or '__HIVE_DEFAULT_PARTITION__'}" for row in fresh.select("dt").distinct().collect()]
    files = [file for name in slices for file in state.files.get(name, [])]
    summed = open_files(spark, path, state, files).unionByName(fresh).groupBy(*FIELDS, "StartTime", "dt").agg(F.sum("n").alias("n"))
    commit(summed.hint("rebalance", "dt"), path, "StartTime", ["dt"], "slices", state, mark)


def _of_minutes(query: ev.EventQuery) -> bool:
    return all(at is None or at == at.replace(second=0, microsecond=0) for at in (query.start, query.end))


def stored_events(spark: SparkSession, store: str, query: ev.EventQuery) -> DataFrame:
    """The stored events that meet the conditions of a query; only days of its range are opened."""
    rows = read_table(spark, _path(store, "events"), query.start, query.end)
    return ev.filter_events(rows, query)


def total(spark: SparkSession, store: str, query: ev.EventQuery) -> int:
    """How many events meet the conditions: from the counts, or from the events if the range does not lie on minutes."""
    if not _of_minutes(query):
        return stored_events(spark, store, query).count()
    return sum(n for _, n in _counts(spark, store, query, "DAY", None))


def page(spark: SparkSession, store: str, query: ev.EventQuery) -> DataFrame:
    """One page of the events that meet a query, in order; see :func:`anemos.operators.events.page_of`."""
    found = stored_events(spark, store, query)
    if not _of_minutes(query):
        return ev.page_of(found, query.page, query.page_size, query.order)
    return ev.page_of(
        found, query.page, query.page_size, query.order, lambda unit, days: _counts(spark, store, query, unit, days))


def _counts(spark: SparkSession, store: str, query: ev.EventQuery, unit: str,
            days: list[dt.datetime | None] | None) -> list[tuple[dt.datetime | None, int]]:
    """Counts per day of the range, or per minute of some days. Days that the range cuts are counted from their minutes."""
    conditions = ev.filtered(query)
    day = dt.timedelta(days=1)
    if unit == "MINUTE":
        known = [at for at in days if at is not None]
        rows = read_table(spark, _path(store, "minute"), min(known, default=None), max(known) + day if known else None)
        wanted = F.to_date("StartTime").isin([at.date() for at in known])
        if None in days:
            wanted = wanted | F.col("StartTime").isNull()
        return _collected(ev.filter_events(rows.where(F.coalesce(wanted, F.lit(False))), conditions), "MINUTE")
    whole = read_table(spark, _path(store, "day"))
    cut = []
    for at in (query.start, query.end):
        if at is not None and at != dt.datetime.combine(at.date(), dt.time()):
            cut.append(at.date())
    counts = _collected(ev.filter_events(whole.where(~F.to_date("StartTime").isin(cut) | F.col("StartTime").isNull()) if cut else whole, conditions), "DAY")
    for date in sorted(set(cut)):
        start = dt.datetime.combine(date, dt.time())
        rows = read_table(spark, _path(store, "minute"), start, start + day)
        rows = rows.where((F.col("StartTime") >= naive(start)) & (F.col("StartTime") < naive(start + day)))
        counts += _collected(ev.filter_events(rows, conditions), "DAY")
    return counts


def _collected(rows: DataFrame, unit: str) -> list[tuple[dt.datetime | None, int]]:
    at = F.date_trunc(unit, "StartTime").cast("timestamp_ntz")
    return [(row["at"], row["n"]) for row in rows.groupBy(at.alias("at")).agg(F.sum("n").alias("n")).collect()]
