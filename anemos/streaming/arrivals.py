"""Streams over arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import reports
from ..plans import upkeep
from ..session import delete_path, materialize, scratch_scope
from ..sinks.tables import merge_slices, stored_table
from ..sources import with_file_keys


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for a stream with state, which shares the cluster and all settings
    that matter but has its own number of state partitions.

    Batch jobs get along with many shuffle partitions, as small ones are put
    together at run time; a stream opens a state store for each, in every batch,
    and keeps their number for the life of its checkpoint. The totals of open
    windows are small, so one partition per core is the default.
    """
    session = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.shuffle.partitions", state_partitions or spark.sparkContext.defaultParallelism)
    return session


def read_arrivals(spark: SparkSession, folder: str, schema: T.StructType, name_glob: str = "*.parquet",
                  files_per_batch: int | None = None, file_keys: bool = False) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder, with the device and
    time their names tell if ``file_keys`` are asked for."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    samples = reader.parquet(folder)
    return with_file_keys(samples) if file_keys else samples


def stream_totals(samples: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Ten-minute totals as a stream; a window is given out once it is closed.

    The watermark needs a timestamp with a zone, so zone-free times are read in
    the session's zone, which should be UTC. State is one row of totals per
    turbine and open window, no samples.
    """
    timed = samples.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", delay)
    return timed.groupBy(F.window("time", "10 minutes"), F.col("turbine").alias("DeviceName")).agg(
        *reports.total_columns()
    )


def stream_reports(samples: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The combined ten-minute report as a stream in append mode."""
    totals = stream_totals(samples, delay)
    start = F.col("window.start").cast("timestamp_ntz").alias("Time")
    return reports.combined(totals.select(start, *[name for name in totals.columns if name != "window"]))


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table, each row exactly once, until the
    input present now is used up."""
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )


def without_replays(samples: DataFrame, within: str) -> DataFrame:
    """A stream without rows that came before, all columns alike, not longer ago than ``within``.

    State holds the rows of that time. The time is that of arrival, so late samples are no less kept than others.
    """
    timed = samples.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return timed.dropDuplicatesWithinWatermark(samples.columns).drop("_arrived")


def merge_arrivals(samples: DataFrame, table: str, checkpoint: str, late_folder: str | None = None,
                   delay: str = "10 minutes", store: str | None = None, hours: bool = False,
                   replay: str | None = None) -> StreamingQuery:
    """Merge a stream of samples into a table with a log, by day, or by day and ``hours`` where days are large.

    For each turbine and time the last arrival wins; of copies within one batch
    the greatest, column by column, is kept. Only the days (hours) a batch touches are read and replaced, in one commit, so
    running a batch again leaves no second copy.
    With ``late_folder``, samples older than the newest of earlier batches by
    more than ``delay`` are also listed in its table ``samples``; :func:`anemos.plans.redo_late` redoes their windows.
    With ``store``, blocks and reports of all windows that a batch touches are made anew at once, late ones
    as others (:func:`anemos.plans.redo_windows`).
    With ``replay``, e.g. ``"2 days"``, a file that comes once more within that time touches nothing (:func:`without_replays`).
    """
    if replay is not None:
        samples = without_replays(samples, replay)
    return (
        samples.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, table, late_folder, delay, store, hours))
        .trigger(availableNow=True).start()
    )


def merge_batch(batch: DataFrame, batch_id: int, table: str, late_folder: str | None = None,
                delay: str = "10 minutes", store: str | None = None, hours: bool = False) -> None:
    """Merge one batch of samples; see :func:`merge_arrivals`."""
    keys = ["turbine", "time"]
    others = [name for name in batch.columns if name not in keys]
    single = batch.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_row")).select(*keys, "_row.*").select(*batch.columns)
    with scratch_scope(batch.sparkSession):
        fresh = materialize(single, "arrivals")
        if late_folder is not None:
            _list_late(fresh, batch_id, late_folder, delay)
        if fresh.isEmpty():
            return
        merge_slices(fresh, table, keys, "time", hours)
        if store is not None:
            upkeep.redo_windows(materialize(upkeep.touched_windows(fresh), "windows"), table, store)


def _list_late(fresh: DataFrame, batch_id: int, folder: str, delay: str) -> None:
    """Keep late samples, replaced when the batch runs again, and the newest time so far.

    That time is one row per batch, of which the last two are kept: a batch that runs
    again needs its predecessor's.
    """
    spark = fresh.sparkSession
    newest = fresh.agg(F.max("time").alias("newest"))
    earlier = stored_table(spark, f"{folder}/bounds/batch={batch_id - 1}", newest.schema)
    if earlier is not None:
        bound = earlier.agg(F.max("newest")).scalar()
        late = fresh.where(F.col("time") < bound - F.expr(f"INTERVAL {delay}"))
        _replace_batch(late.withColumn("batch", F.lit(batch_id).cast("bigint")), f"{folder}/samples")
        newest = newest.unionByName(earlier).agg(F.max("newest").alias("newest"))
    newest.write.mode("overwrite").parquet(f"{folder}/bounds/batch={batch_id}")
    delete_path(spark, f"{folder}/bounds/batch={batch_id - 2}")


def _replace_batch(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def store_arrivals(arrivals: DataFrame, store: str, checkpoint: str, zero_nulls: bool = False) -> StreamingQuery:
    """Reports of arriving files into the report store, as files come in.

    ``arrivals`` is a stream with the file keys of :func:`read_arrivals`. A report is made from all files of its
    device and ten minutes, whichever batches they came in, and a batch that runs again, whole or in part, leaves no
    second copy; see :func:`anemos.plans.merge_file_reports`.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        upkeep.merge_file_reports(batch, store, zero_nulls)

    return (
        arrivals.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
        .trigger(availableNow=True).start()
    )
