"""One runnable query per operator, over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions.buckets import naive, time_bucket
from ..functions.filenames import device_of, report_time_of, sample_time_of
from ..functions.levels import level_number, level_text
from ..operators import availability, blocks, conditions, duplicates, energy, events, metrics, periods, power_model, reports, schemas
from ..operators.peers import mean_winds, nearest_peers
from ..operators.resample import in_range, resample
from ..plans import event_store, jobs, upkeep
from ..session import materialize, scratch_path
from ..sinks import event_layout, report_layout, write_resampled
from ..sinks.layout import recluster
from ..sinks.snapshots import commit, read_table
from ..sinks.tables import append_rows, write_json_lines
from ..sources import (
    file_inventory, file_schemas, list_files, read_grid_dates, read_turbine_info, report_rows, scan_arrivals, scan_files_named, scan_reports,
    scan_telemetry, standard_curves,
)
from ..streaming import keep_open_events, merge_arrivals, open_event_session, read_arrivals, stream_reports, stream_session, write_stream
from ..streaming.arrivals import merge_batch
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

NOISE = 1e-12
FROM, UNTIL = dt.datetime(2024, 1, 1, 2, 3), dt.datetime(2024, 1, 31, 1, 0)
STREAM_CUT = dt.datetime(2024, 1, 12, 0, 5)
REQUEST_DAYS = dt.date(2024, 1, 4), dt.date(2024, 1, 21)
FIRST_DAY, LAST_DAY = dt.date(2023, 12, 30), dt.date(2024, 2, 1)
BUCKETS = ("10 MINUTE", "5 HOUR", "2 DAY", "2 WEEK", "5 MONTH", "1 QUARTER", "2 YEAR")
FORMULAS = {
    "LossShare": "FaultLossGeneration / (GriActiveEnergyDelTotal + FaultLossGeneration) * 100",
    "Busy": "Count > 1 && FaultShutdownDuration < 1 ? 1 : 0",
    "MeterRange": "GriActiveEnergyDelLast - PreTotalGenerationFirst",
    "PerZero": "Count / (Count - Count)",
    "Repair": "MTTRDuration ?? 0 - 1",
    "Rare": "YawCwTimesSum in (0, 1, GriActiveEnergyDelTotal - GriActiveEnergyDelTotal) ? 1 : 0",
    "OfTwo": "DeviceName =~ '^p.*r$' && DeviceName !~ 'x|y'",
    "Title": "[DeviceName] + ': ' + YawCwTimesSum",
    "Bits": "(YawCwTimesSum & 6 | 1) ^ 2 << 1",
    "Since": "Time >= '2024-01-10 00:00:00' ? 'new' : 'old'",
    "Climb": "-2 ** 2 ** 0 + +3 * 2 % 4 - ~1",
}
ROLLUP_COLUMNS = (
    "Count", "Met1sWSpdAvg", "Met1sWSpdMax", "Met1sWSpdMin", "GriActiveEnergyDelTotal", "GriActiveEnergyDelLast",
    "PreTotalGenerationFirst", "YawCwTimesSum", "FaultShutdownDuration", "MTBFDuration", "MTTRDuration", "Availability",
    "FaultLossGeneration", "EnergyAvailability",
)
ADDED_COLUMNS = (
    "Count", "Met1sWSpdAvg", "Met1sWSpdMax", "FaultShutdownDuration", "FaultShutdownTimes", "AvailableTime", "YawHours",
    "GriActiveEnergyDelTotal", "GriActiveEnergyDelLast", "PreTotalGenerationFirst", "TheoreticalGeneration",
    "FaultLossGeneration", "EquivalentHours", "Availability", "MTBFDuration", "MTTRDuration", "EnergyAvailability",
    "Discrepancy",
)
STORED_COLUMNS = ("Count", "YawHours", "Met1sWSpdAvg", "Met1sWSpdMax", "GriActiveEnergyDelTotal", "Availability", "MTBFDuration")
BLOCK_RANGE = dt.datetime(2024, 1, 1, 2, 10), dt.datetime(2024, 1, 31, 1, 20)
SIGNALS = {"MC004": ["avg", "max"], "MC006": ["last", "first"], "MC132": ["count"], "Generation": ["sum", "min"]}
SIGNAL_TITLES = {"MC004": "wind_", "MC006": "meter_", "Generation": "made_"}
EVENT_QUERY = events.EventQuery(
    system="turbine", category="event", devices=[("farm0", []), ("farm1", ["d1", "d5", "d13"]), ("farm3", [])],
    levels=[0, 1, 2, 4], start=FROM, end=UNTIL, order="desc",
)
EVENT_COLUMNS = [
    {"field": "MessageId", "title": "编号"},
    {"field": "StartTime", "title": "开始时间", "time_format": "2006-01-02 15:04:05"},
    {"field": "EndTime", "title": "End"},
    {"field": "EventLevelStr", "title": "Level"},
    {"field": "ConfirmedTimeStr", "title": "Confirmed at"},
    {"field": "FirstEvent", "title": "First"},
    {"field": "Missing", "title": "Missing"},
]
REPORT_TITLES = {
    "YawHours": "Yaw", "Met1sWSpdAvg": "Wind", "Time": "时间", "EquivalentHours": "Hours", "DeviceName": "Turbine",
    "Count": "Rows", "Absent": "Absent",
}

_registry: dict[str, Query] = {}


def _query(function: Query) -> Query:
    """Register a query that adds doubles up.

    Two engines add doubles in different orders and differ in the last digits.
    Results are compared at single precision, which both engines round to in
    binary; decimal rounding would split values that lie half way.
    """
    def settled(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = function(spark, sf_dir)

        def kept(name: str, kind: str) -> str:
            if kind != "double":
                return f"`{name}`"
            return f"CASE WHEN abs(`{name}`) < {NOISE} THEN 0D ELSE CAST(CAST(`{name}` AS FLOAT) AS DOUBLE) END AS `{name}`"

        return df.selectExpr(*[kept(name, kind) for name, kind in df.dtypes])

    _registry[function.__name__.rstrip("_")] = settled
    return function


def _exact(function: Query) -> Query:
    """Register a query whose doubles both engines make alike to the last bit."""
    _registry[function.__name__.rstrip("_")] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_registry)


# --- scans ---------------------------------------------------------------


@_exact
def scan_filtered(spark, sf_dir):
    picked = in_range(fx.telemetry(spark, sf_dir), FROM, UNTIL, fx.DEVICES[:4])
    return picked.select("time", "turbine", "MC004", "MC006", "MC143")


@_exact
def scan_device_day(spark, sf_dir):
    return sources.scan_device_day(fx.telemetry(spark, sf_dir), fx.DEVICES[1], dt.date(2024, 1, 9)).select(
        "time", "turbine", "MC004", "MC531"
    )


@_query
def report_scan(spark, sf_dir):
    rows = reports.summary(_totals(spark, sf_dir))
    return report_rows(rows, ["Time", "DeviceName", "Met1sWSpdAvg", "YawHours"], fx.DEVICES[2:], FROM, UNTIL)


@_exact
def file_report_time(spark, sf_dir):
    names = fx.telemetry(spark, sf_dir).select(
        F.concat("turbine", F.lit("_"), F.date_format("time", "yyyyMMddHHmm"), F.lit("_samples.parquet")).alias("file")
    )
    keyed = names.select(
        "file", device_of(F.col("file")).alias("device"), sample_time_of(F.col("file")).alias("sample_time")
    )
    return keyed.withColumn("report_time", report_time_of(F.col("file")))


@_exact
def file_columns(spark, sf_dir):
    return file_inventory(list_files(spark, sf_dir, [sf_dir]))


@_exact
def schema_conflicts(spark, sf_dir):
    """Types of every column of every file below the folder."""
    return schemas.file_conflicts(file_schemas(list_files(spark, sf_dir)))


# --- time and resample ---------------------------------------------------


def _bucket_counts(samples: DataFrame, every: Sequence[str]) -> DataFrame:
    """Samples per combination of buckets, finest width first.

    Samples are grouped once by the finest bucket; the coarser ones, which must
    be multiples of it, are taken from its start.
    """
    finest, *coarser = every
    counted = samples.groupBy(time_bucket("time", finest).alias("b0")).agg(F.count(F.lit(1)).alias("samples"))
    for place, width in enumerate(coarser, 1):
        counted = counted.withColumn(f"b{place}", time_bucket("b0", width))
    return counted


@_exact
def time_bucket_(spark, sf_dir):
    return _bucket_counts(fx.telemetry(spark, sf_dir), BUCKETS)


@_query
def resample_(spark, sf_dir):
    return resample(
        fx.telemetry(spark, sf_dir), "1 HOUR", SIGNALS, titles=SIGNAL_TITLES, start=FROM, end=UNTIL, devices=fx.DEVICES
    )


@_query
def resample_weeks(spark, sf_dir):
    return resample(fx.telemetry(spark, sf_dir), "2 week", SIGNALS, columns=["MC004", "MC132", "MC093"])


@_query
def resample_csv(spark, sf_dir):
    """Resampled signals written as CSV, a folder per turbine, and read back."""
    rows = resample(fx.telemetry(spark, sf_dir), "1 HOUR", SIGNALS, titles=SIGNAL_TITLES, start=FROM, end=UNTIL, devices=fx.DEVICES)
    path = scratch_path(spark, "resampled")
    write_resampled(rows, path, per_device=True)
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return spark.read.schema(f"{kinds}, device string").csv(path, header=True).where("device = turbine").drop("device")


@_exact
def arriving_files(spark, sf_dir):
    """Samples as files named after a turbine and a time, and what their names tell."""
    samples, parts = fx.telemetry(spark, sf_dir).select("time", "turbine", "MC004"), scratch_path(spark, "parts")
    keyed = samples.select("time", "MC004", "turbine", F.date_format("time", "yyyyMMdd").alias("day"))
    keyed.repartition("turbine", "day").write.partitionBy("turbine", "day").parquet(parts)
    folder = scratch_path(spark, "arriving")
    where = spark._jvm.org.apache.hadoop.fs.Path
    store = where(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(where(folder))
    for found in store.globStatus(where(f"{parts}/turbine=*/day=*/part-*")):
        turbine, day = (found.getPath().toString().split(f"/{name}=")[1].split("/")[0] for name in ("turbine", "day"))
        store.rename(found.getPath(), where(f"{folder}/{turbine}_{day}0000_samples.parquet"))
    schema = keyed.drop("turbine", "day").schema
    return scan_arrivals(spark, folder, schema=schema).drop("file_path")


def _spans(spark, sf_dir):
    """From the first to the last sample of every turbine and label."""
    return fx.telemetry(spark, sf_dir).groupBy("turbine", F.col("MC531").alias("label")).agg(
        F.min("time").alias("start"), F.max("time").alias("end")
    )


@_exact
def period_grid(spark, sf_dir):
    spans = _spans(spark, sf_dir)
    grids = [periods.period_grid(spans.withColumn("period", F.lit(p)), p) for p in ("hour", "day", "month", "year")]
    result = grids[0]
    for grid in grids[1:]:
        result = result.unionByName(grid)
    return result


@_exact
def period_grid_days(spark, sf_dir):
    return periods.day_grid(_spans(spark, sf_dir))


# --- merge and duplicates ------------------------------------------------


def _halves(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    return orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 <> 0")


@_exact
def merge_same_schema(spark, sf_dir):
    return schemas.merge_by_name(*_halves(spark, sf_dir)).orderBy("o_orderdate")


@_exact
def merge_by_name(spark, sf_dir):
    even, odd = _halves(spark, sf_dir)
    return schemas.merge_by_name(
        even.drop("o_orderpriority").withColumn("x", F.lit(1)), odd.drop("o_totalprice")
    ).orderBy("o_orderdate")


def _flags(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")


@_exact
def duplicate_keys(spark, sf_dir):
    return duplicates.duplicate_keys(_flags(spark, sf_dir), ["l_orderkey", "l_returnflag"])


@_exact
def distinct_rows(spark, sf_dir):
    return duplicates.distinct_rows(_flags(spark, sf_dir))


# --- reports -------------------------------------------------------------


def _totals(spark, sf_dir):
    return reports.window_totals(fx.telemetry(spark, sf_dir))


@_query
def report_summary(spark, sf_dir):
    return reports.summary(_totals(spark, sf_dir))


@_query
def report_availability(spark, sf_dir):
    return reports.availability(_totals(spark, sf_dir))


@_query
def report_efficiency(spark, sf_dir):
    return reports.efficiency(_totals(spark, sf_dir))


@_query
def report_combined(spark, sf_dir):
    return reports.combined(_totals(spark, sf_dir))


def _rollup(spark, sf_dir, period, formulas=None):
    return jobs.stored_report(
        reports.combined(_totals(spark, sf_dir)), fx.GROUPS, period, FROM, UNTIL, ROLLUP_COLUMNS, formulas
    )


@_query
def report_rollup_10min(spark, sf_dir):
    return _rollup(spark, sf_dir, "10min")


@_query
def report_rollup_hour(spark, sf_dir):
    return _rollup(spark, sf_dir, "hour")


@_query
def report_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir, "day")


@_query
def report_rollup_month(spark, sf_dir):
    return _rollup(spark, sf_dir, "month")


@_query
def report_rollup_year(spark, sf_dir):
    return _rollup(spark, sf_dir, "year")


@_query
def report_rollup_additive(spark, sf_dir):
    rows = reports.combined(_totals(spark, sf_dir))
    return jobs.stored_report(rows, fx.GROUPS, "day", FROM, UNTIL, ADDED_COLUMNS, rules="additive")


def _level_reports(levels, names, columns):
    """Report rows of blocks of several levels."""
    rows = None
    for name in names:
        made = blocks.block_reports(levels[name], ["Time", "DeviceName", *columns]).select(F.lit(name).alias("level"), "*")
        rows = made if rows is None else rows.unionByName(made)
    return rows


def _stored_blocks(spark, sf_dir):
    store = scratch_path(spark, "block-store")
    upkeep.store_blocks(fx.telemetry(spark, sf_dir), store)
    return store


@_query
def report_blocks(spark, sf_dir):
    """All report columns of hours, days and months, from stored blocks."""
    levels = upkeep.scan_blocks(spark, _stored_blocks(spark, sf_dir))
    return _level_reports(levels, ["hour", "day", "month"], metrics.COMBINED_COLUMNS[2:])


@_query
def report_rollup_exact(spark, sf_dir):
    """Days of groups of turbines, from stored blocks."""
    store = _stored_blocks(spark, sf_dir)
    return jobs.exact_report(spark, store, fx.GROUPS, "day", FROM, UNTIL, ADDED_COLUMNS)


@_query
def report_range_exact(spark, sf_dir):
    """One row per group for a range, from the fewest stored blocks that cover it."""
    store = _stored_blocks(spark, sf_dir)
    return jobs.exact_range_report(spark, store, fx.GROUPS, *BLOCK_RANGE, ADDED_COLUMNS)


@_query
def report_expressions(spark, sf_dir):
    return _rollup(spark, sf_dir, "day", FORMULAS).select("Time", "DeviceName", *FORMULAS)


@_exact
def report_csv_layout(spark, sf_dir):
    rows = reports.combined(_totals(spark, sf_dir)).select(
        "Time", "DeviceName", "Count", "YawHours",
        F.round("Met1sWSpdAvg", 6).alias("Met1sWSpdAvg"), F.round("EquivalentHours", 6).alias("EquivalentHours"),
    )
    return report_layout(rows, REPORT_TITLES)


def _ad_hoc(spark, sf_dir, kind):
    return jobs.ad_hoc_report(fx.telemetry(spark, sf_dir), kind, fx.GROUPS, FROM, UNTIL)


@_query
def ad_hoc_summary(spark, sf_dir):
    return _ad_hoc(spark, sf_dir, "SummaryReport")


@_query
def ad_hoc_availability(spark, sf_dir):
    return _ad_hoc(spark, sf_dir, "TurbineAvailabilityMetrics")


@_query
def ad_hoc_efficiency(spark, sf_dir):
    return _ad_hoc(spark, sf_dir, "EfficiencyMetrics")


# --- availability --------------------------------------------------------


def _sums(spark, sf_dir):
    return conditions.condition_sums(fx.telemetry(spark, sf_dir))


@_exact
def label_mode(spark, sf_dir):
    return conditions.label_mode(conditions.valid(_sums(spark, sf_dir)))


@_exact
def tba_minutes(spark, sf_dir):
    return availability.daily_minutes(conditions.condition_sums(fx.telemetry(spark, sf_dir), "1 DAY"))


@_exact
def tba_calendar(spark, sf_dir):
    return jobs.tba(fx.telemetry(spark, sf_dir), FIRST_DAY, LAST_DAY)


@_query
def pba_five_minute(spark, sf_dir):
    return energy.five_minute_rows(_sums(spark, sf_dir))


@_query
def pba_ten_minute(spark, sf_dir):
    return energy.ten_minute_rows(_sums(spark, sf_dir))


def _expected(spark, rows, fit="line"):
    second = standard_curves(spark).where("turbine_type = '10MW'")
    return energy.with_expected(rows, fx.turbine_info(spark), standard_curves(spark), second, fit)


@_query
def pba_expected(spark, sf_dir):
    return _expected(spark, energy.five_minute_rows(_sums(spark, sf_dir)))


@_query
def pba_expected_forest(spark, sf_dir):
    return _expected(spark, energy.five_minute_rows(_sums(spark, sf_dir)), "forest")


@_query
def pba_model(spark, sf_dir):
    """How far forests learnt from the even days are off on the odd days, per type, and how much power varies there."""
    rows = materialize(energy.with_turbine_info(energy.five_minute_rows(_sums(spark, sf_dir)), fx.turbine_info(spark)), "model-rows")
    even = F.dayofmonth("w") % 2 == 0
    models = power_model.fit_power(rows.where(even))
    made = power_model.with_model_power(rows.where(~even & (F.col("label") == conditions.NORMAL)), models)
    return made.groupBy("turbine_type").agg(
        F.count("model_power").alias("rows"), F.sqrt(F.avg(F.pow(F.col("model_power") - F.col("power"), 2))).alias("error"),
        F.stddev_pop("power").alias("spread"))


def _energy_rows(spark, sf_dir):
    sums = materialize(_sums(spark, sf_dir), "condition-sums")
    both = energy.five_minute_rows(sums).unionByName(energy.ten_minute_rows(sums))
    return materialize(_expected(spark, both), "energy-rows")


@_query
def pba_nearest_peers(spark, sf_dir):
    rows = energy.five_minute_rows(_sums(spark, sf_dir))
    return nearest_peers(mean_winds(energy.with_turbine_info(rows, fx.turbine_info(spark))))


@_query
def pba_potential(spark, sf_dir):
    rows = _expected(spark, energy.five_minute_rows(_sums(spark, sf_dir)))
    return energy.with_potential(materialize(rows, "energy-rows"))


@_query
def pba_potential_ten(spark, sf_dir):
    rows = _expected(spark, energy.ten_minute_rows(_sums(spark, sf_dir)))
    return energy.with_potential(materialize(rows, "energy-rows"))


@_query
def pba_daily(spark, sf_dir):
    return energy.daily_energy(energy.with_potential(_energy_rows(spark, sf_dir)))


# --- events --------------------------------------------------------------


def _decoded(spark, sf_dir):
    return events.decode(fx.messages(spark, sf_dir))


@_exact
def events_decoded(spark, sf_dir):
    decoded = _decoded(spark, sf_dir)
    return events.select_fields(decoded).withColumns({
        "level_of_text": level_number(F.col("EventLevelStr")),
        "level_of_number": level_number(F.col("EventLevel")),
        "text_of_level": level_text(F.col("EventLevel")),
        "StartMillis": F.unix_millis(F.col("StartTime").cast("timestamp")),
    })


@_exact
def events_history(spark, sf_dir):
    return events.select_fields(events.history(_decoded(spark, sf_dir), EVENT_QUERY), ["MessageId", "StartTime", "Device"])


@_exact
def events_history_total(spark, sf_dir):
    return events.history_total(_decoded(spark, sf_dir), EVENT_QUERY)


@_exact
def events_page(spark, sf_dir):
    return events.page_of(_decoded(spark, sf_dir), 3, 25, "desc").select("MessageId", "StartTime")


@_exact
def events_page_late(spark, sf_dir):
    """The page around the middle of all events, past the rows a top-k is used for."""
    return events.page_of(_decoded(spark, sf_dir), 4, 2_500, "asc").select("MessageId", "StartTime")


@_exact
def events_page_stored(spark, sf_dir):
    """A late page of a query, found from stored counts; the events came in two batches, one of them twice."""
    store, decoded = scratch_path(spark, "event-store"), _decoded(spark, sf_dir)
    half = F.col("EventLevel") <= 1
    for n, batch in ((0, decoded.where(half)), (1, decoded.where(~half)), (1, decoded.where(~half))):
        event_store.add_events(batch, store, n)
    return event_store.page(spark, store, replace(EVENT_QUERY, page=4, page_size=50)).select("MessageId", "StartTime")


@_exact
def events_open(spark, sf_dir):
    return events.open_events(_decoded(spark, sf_dir), EVENT_QUERY).select("MessageId", "FarmCode", "Device", "EventLevel")


@_exact
def events_flattened(spark, sf_dir):
    flat = events.flatten_by_parent(fx.messages(spark, sf_dir))
    return flat.select("MessageId", "RelevantId", "root_id", "depth", F.array_join("path", "/").alias("path"))


def _nested(spark, sf_dir):
    """Each message with one related message per confirmation and level."""
    flat = fx.messages(spark, sf_dir)
    plain = [name for name in flat.columns if name not in ("MessageId", "RelevantId")]

    def child(suffix, *more):
        return F.struct(F.concat("MessageId", F.lit(suffix)).alias("MessageId"),
                        F.col("MessageId").alias("RelevantId"), *plain, *more)

    inner = F.when(F.col("EventLevel") > 2, F.array(child(".a.x"), child(".a.y"))).alias("Relevant")
    none = F.when(F.lit(False), F.array(child(".b.x"))).alias("Relevant")
    outer = F.when(F.col("Confirmed") == 1, F.array(child(".a", inner), child(".b", none)))
    return flat.withColumn("Relevant", outer)


@_exact
def events_flattened_nested(spark, sf_dir):
    flat = events.flatten_nested(_nested(spark, sf_dir))
    return flat.select("root_id", "position", "depth", "MessageId", "RelevantId", "EventLevel", "StartTime")


@_exact
def event_csv_layout(spark, sf_dir):
    return event_layout(_decoded(spark, sf_dir), EVENT_COLUMNS)


# --- streams -------------------------------------------------------------


@_query
def stream_ten_minute(spark, sf_dir):
    session = stream_session(spark)
    schema = fx.table(spark, sf_dir, "events").schema
    arriving = read_arrivals(session, sf_dir, schema, name_glob="events.parquet")
    samples = session.sql(fx.TELEMETRY_SQL, events=arriving)
    out, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    rows = stream_reports(samples)
    write_stream(rows, out, state).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


@_exact
def replayed_files(spark, sf_dir):
    """The table of samples after a stream in which each file comes twice."""
    samples = fx.telemetry(spark, sf_dir).select("time", "turbine", "MC004")
    folder, table, state = (scratch_path(spark, f"replay-{name}") for name in ("in", "table", "state"))
    session = stream_session(spark)
    for _ in range(2):
        samples.repartition(1).write.mode("append").parquet(folder)
        merge_arrivals(read_arrivals(session, folder, samples.schema), table, state, replay="2 days").awaitTermination()
    return read_table(spark, table).drop("dt")


def _event_batches(spark, sf_dir):
    """Messages in three batches: some events, then the others and the ends of some of the first, then older messages of ended ones."""
    messages = fx.messages(spark, sf_dir).select("MessageId", "FarmCode", "Device", "EventLevel", "StartTime", "EndTime", "ConfirmedTime")
    number = F.col("MessageId").cast("bigint")
    early, ends = number % 3 != 0, (number % 10 == 2) & (number % 3 != 0)
    last = messages.where(ends).withColumn("EndTime", F.col("StartTime") + 1)
    return [messages.where(early), messages.where(~early).unionByName(last), messages.where(ends)]


@_exact
def events_open_stream(spark, sf_dir):
    """The table of open events after a stream of three batches."""
    folder, table, state = (scratch_path(spark, f"open-{name}") for name in ("in", "table", "state"))
    session = open_event_session(spark)
    for batch in _event_batches(spark, sf_dir):
        batch.write.mode("append").parquet(folder)
        keep_open_events(read_arrivals(session, folder, batch.schema), table, state).awaitTermination()
    return read_table(spark, table)


@_exact
def events_open_now(spark, sf_dir):
    """The same by one query over all messages."""
    first, second, third = _event_batches(spark, sf_dir)
    return events.open_now(first.unionByName(second).unionByName(third))


# --- tables written and read back ----------------------------------------


@_exact
def files_named(spark, sf_dir):
    return scan_files_named(
        spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"])


@_exact
def merge_files_(spark, sf_dir):
    """Two files with different columns merged into the first, which starts as a copy by the same job."""
    even, odd = _halves(spark, sf_dir)
    absent, first, second = (scratch_path(spark, name) for name in ("merge-absent", "merge-first", "merge-second"))
    append_rows(even.drop("o_orderpriority"), second)
    jobs.merge_files(spark, absent, second, first, "o_orderdate")
    second = scratch_path(spark, "merge-second")
    append_rows(odd.where("o_orderkey % 4 = 1").drop("o_totalprice"), second)
    append_rows(odd.where("o_orderkey % 4 <> 1").drop("o_totalprice"), second)
    jobs.merge_files(spark, first, second, first, "o_orderdate")
    return read_table(spark, first)


@_exact
def merge_arrivals_by_name(spark, sf_dir):
    """Two batches with columns of their own and turbine-seconds in common."""
    samples, table = fx.telemetry(spark, sf_dir), scratch_path(spark, "arrivals-table")
    merge_batch(samples.where("MC006 % 3 <> 2").select("time", "turbine", "MC004", "MC143"), 0, table)
    merge_batch(samples.where("MC006 % 3 <> 0").select("time", "turbine", "MC004", "MC006"), 1, table)
    return scan_telemetry(spark, table, start=FROM, end=UNTIL).select(
        "time", "turbine", "MC004", "MC143", "MC006")


@_exact
def device_month(spark, sf_dir):
    """Two turbines over most of a month, from a table that came in parts and was then laid out by turbine and time."""
    samples, table = fx.telemetry(spark, sf_dir).select("time", "turbine", "MC004", "MC143"), scratch_path(spark, "layout")
    running = F.col("MC143") == 120
    for part in (running, ~running):
        commit(samples.where(part).withColumn("dt", F.to_date("time")), table, "time", ["dt"], "nothing")
    recluster(spark, table, FROM.date(), UNTIL.date(), files=4)
    return scan_telemetry(spark, table, start=FROM, end=UNTIL, devices=fx.DEVICES[1:3]).drop("dt")


@_exact
def late_samples(spark, sf_dir):
    """What a batch brings that is older than the batch before it allows."""
    samples = fx.telemetry(spark, sf_dir).select("time", "turbine", "MC143")
    table, late = scratch_path(spark, "late-table"), scratch_path(spark, "late")
    newer = F.col("time") >= naive(STREAM_CUT)
    merge_batch(samples.where(newer), 0, table, late)
    merge_batch(samples.where(~newer), 1, table, late)
    return spark.read.parquet(f"{late}/samples").select("time", "turbine", "MC143")


def _stored(spark, store):
    """Columns of two of the stored reports, row by row."""
    rows = scan_reports(spark, store, "SummaryReport").join(
        scan_reports(spark, store, "TurbineAvailabilityMetrics").drop("Count", "dt"), ["Time", "DeviceName"])
    return rows.select("Time", "DeviceName", *STORED_COLUMNS)


@_query
def late_windows(spark, sf_dir):
    """The report store after two batches, the second of which is late and in windows that the first has, too."""
    samples, table, store = fx.telemetry(spark, sf_dir), scratch_path(spark, "late-table"), scratch_path(spark, "late-store")
    first = (F.col("time") >= naive(STREAM_CUT)) | (F.col("MC006") % 2 == 0)
    merge_batch(samples.where(first), 0, table, store=store)
    merge_batch(samples.where(~first), 1, table, store=store)
    return _stored(spark, store)


@_query
def late_blocks(spark, sf_dir):
    """Blocks of days and months after the same two batches, the late windows redone from the list of late samples."""
    samples, (table, late, store) = fx.telemetry(spark, sf_dir), [scratch_path(spark, f"redo-{name}") for name in ("table", "late", "store")]
    first = (F.col("time") >= naive(STREAM_CUT)) | (F.col("MC006") % 2 == 0)
    merge_batch(samples.where(first), 0, table, late, store=store)
    merge_batch(samples.where(~first), 1, table, late)
    upkeep.redo_late(spark, late, table, store)
    return _level_reports(upkeep.scan_blocks(spark, store), ["day", "month"], STORED_COLUMNS)


@_query
def file_reports(spark, sf_dir):
    """Reports of files that come in two batches, two files for each ten minutes; some come again."""
    samples, store = fx.telemetry(spark, sf_dir), scratch_path(spark, "file-store")
    name = F.concat("turbine", F.lit("_"), F.date_format("time", "yyyyMMddHHmm"), F.lit("_"), F.col("MC006") % 2, F.lit(".parquet"))
    arrived = samples.withColumn("file_path", name).withColumns({
        "file_device": device_of(F.col("file_path")), "file_time": sample_time_of(F.col("file_path"))})
    upkeep.merge_file_reports(arrived.where("MC006 % 2 = 0"), store)
    upkeep.merge_file_reports(arrived.where((F.col("MC006") % 2 == 1) | (F.col("turbine") == fx.DEVICES[0])), store)
    return _stored(spark, store)


@_query
def report_store(spark, sf_dir):
    """All samples reported and stored, half of them once more; each window is there once."""
    samples, store = fx.telemetry(spark, sf_dir), scratch_path(spark, "store")
    made = jobs.ten_minute_reports(samples)
    jobs.store_reports(made, store)
    jobs.merge_reports({kind: rows.where(F.col("DeviceName") <= fx.DEVICES[2]) for kind, rows in made.items()}, store)
    columns = ["Time", "DeviceName", "Count", "YawHours", "Met1sWSpdMax"]
    return report_rows(scan_reports(spark, store, "SummaryReport"), columns, fx.DEVICES[1:], FROM, UNTIL)


@_query
def report_json_lines(spark, sf_dir):
    rows = reports.summary(_totals(spark, sf_dir)).select("Time", "DeviceName", "Count", "Met1sWSpdAvg")
    path = scratch_path(spark, "report-lines")
    write_json_lines(rows, path)
    return spark.read.schema(rows.schema).json(path)


@_exact
def events_exported(spark, sf_dir):
    path = scratch_path(spark, "events-csv")
    jobs.export_events(fx.messages(spark, sf_dir), EVENT_QUERY, EVENT_COLUMNS, path)
    names = [column["field"] for column in EVENT_COLUMNS]
    cells = spark.read.csv(path, header=True, schema=", ".join(f"{name} string" for name in names))
    return cells.fillna("")


@_exact
def turbine_info_file(spark, sf_dir):
    """One farm of a file of all farms."""
    path = scratch_path(spark, "turbines")
    fx.table(spark, sf_dir, "supplier").selectExpr(
        "concat('farm', s_nationkey % 3) AS farm", "s_name AS turbine", "if(s_suppkey % 2 = 0, '8MW', '10MW') AS turbine_type",
        "s_suppkey % 4 AS cut_in", "if(s_suppkey % 5 = 0, null, 25) AS cut_out",
    ).write.csv(path, header=True)
    return read_turbine_info(spark, path, "farm1")


@_exact
def grid_dates_file(spark, sf_dir):
    path = scratch_path(spark, "grid-dates")
    fx.table(spark, sf_dir, "events").selectExpr(
        "concat('t', event_id) AS turbine", "date_trunc('second', ts) AS on_grid",
        "if(event_id % 3 = 0, null, date_trunc('day', ts)) AS trial_end",
    ).write.csv(path, header=True, timestampFormat="yyyy-MM-dd HH:mm:ss")
    return read_grid_dates(spark, path)


# --- whole jobs ----------------------------------------------------------


def _two_farms(spark, sf_dir):
    samples = fx.telemetry(spark, sf_dir)
    return samples.withColumn("farm", F.lit("north")).unionByName(
        samples.where("MC006 % 3 = 0").withColumn("farm", F.lit("south")))


def _requested(spark, sf_dir):
    international = standard_curves(spark).where("turbine_type = '10MW'")
    return jobs.tba_and_pba(
        _two_farms(spark, sf_dir), fx.turbine_info(spark), standard_curves(spark), *REQUEST_DAYS, international=international)


@_query
def pba_two_farms(spark, sf_dir):
    """Energy of the days of a request, of two farms that have turbines of one type."""
    return _requested(spark, sf_dir)[1]


@_exact
def tba_two_farms(spark, sf_dir):
    return _requested(spark, sf_dir)[0].select("farm", "turbine", "record_date", "label", "duration")
