"""Parquet tables: merged telemetry and the report store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.schemas import SchemaConflict, conflicts_between
from .snapshots import Snapshot, commit, is_table, open_files, read_table, snapshot

STORE_DIGITS = 6


def write_sorted(df: DataFrame, path: str, by: str = "time", partitions: int | None = None,
                 base: Snapshot | None = None) -> None:
    """Replace a table by rows in time order: ordered over and within the files.

    Readers see the old rows until all new ones are written. Parquet files that lay in the folder without a log go afterwards.
    """
    ranged = df.repartitionByRange(partitions, by) if partitions else df.repartitionByRange(by)
    commit(ranged.sortWithinPartitions(by), path, time=by, replace="all", base=base)
    _remove_plain(df.sparkSession, path)


def _remove_plain(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(where):
        if status.getPath().getName()[:1] not in "_.":
            store.delete(status.getPath(), True)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a table, in whatever order."""
    df.write.mode("append").parquet(path)


def store_form(rows: DataFrame, zero_nulls: bool = False) -> DataFrame:
    """Report rows as the store keeps them: six decimals, and 0 for missing
    values if asked for."""
    def kept(field: T.StructField):
        column = F.col(field.name)
        if not isinstance(field.dataType, T.DoubleType):
            return column
        column = F.round(column, STORE_DIGITS)
        return (F.coalesce(column, F.lit(0.0)) if zero_nulls else column).alias(field.name)

    return rows.select(*[kept(field) for field in rows.schema.fields])


def with_slices(rows: DataFrame, time: str, hours: bool = False) -> DataFrame:
    """Add the partition columns ``dt`` and, if asked for, ``hr``."""
    rows = rows.withColumn("dt", F.to_date(time))
    return rows.withColumn("hr", F.hour(time)) if hours else rows


def write_days(rows: DataFrame, path: str, time: str, hours: bool = False) -> None:
    """Write rows as plain Parquet partitioned by day, or by day and hour; days (hours) present in
    ``rows`` replace those stored.

    A rerun of a day therefore leaves no duplicates. Folders are replaced one by one, so a reader may see some of
    the days; :func:`commit_slices` replaces them at once. Rows are rebalanced by
    partition: small ones share a task, one that holds much of the data is split.
    """
    keys = ["dt", "hr"] if hours else ["dt"]
    rows = with_slices(rows, time, hours).hint("rebalance", *keys)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def _slices(hours: bool) -> list[str]:
    return ["dt", "hr"] if hours else ["dt"]


def commit_slices(rows: DataFrame, path: str, time: str, hours: bool = False, base: Snapshot | None = None,
                  mark: tuple[str, int] | None = None) -> Snapshot:
    """Replace the days (hours) that ``rows`` has, in one commit; see :func:`anemos.sinks.snapshots.commit`.

    Rows are rebalanced by partition: small ones share a task, one that holds much of the data is split.
    """
    rows = with_slices(rows, time, hours).hint("rebalance", *_slices(hours))
    return commit(rows, path, time, _slices(hours), "slices", base, mark)


def merge_slices(fresh: DataFrame, path: str, keys: Sequence[str], time: str, hours: bool = False,
                 mark: tuple[str, int] | None = None, touched: DataFrame | None = None) -> Snapshot:
    """Merge rows into a table with a log, by day (and hour): a row replaces the stored one with the same keys.

    Columns are merged by name: those that only the stored or only the fresh rows
    have stay, null for the others; one with two types is an error. Only the days (hours) of ``fresh`` are read and
    written, which the log names; merging the same rows again changes nothing. If another writer changes one of
    them meanwhile, the merge is an error and nothing is written. ``fresh`` is read several times: pass a table, or
    with ``touched`` the keys and times of all that it replaces, which are then read in its place.
    """
    spark, slices = fresh.sparkSession, _slices(hours)
    touched = with_slices(fresh if touched is None else touched, time, hours)
    fresh = with_slices(fresh, time, hours)
    state = snapshot(spark, path) or Snapshot(-1, fresh.schema, tuple(slices), time, {}, {})
    merged = fresh
    if state.files:
        found = ["/".join(f"{name}={row[name]}" for name in slices) for row in touched.select(*slices).distinct().collect()]
        files = [file for name in found for file in state.files.get(name, [])]
        conflicts = conflicts_between(state.schema, fresh.schema)
        if conflicts:
            raise SchemaConflict(conflicts)
        kept = open_files(spark, path, state, files).join(touched.select(*keys), list(keys), "left_anti")
        merged = kept.unionByName(fresh, allowMissingColumns=True)
    return commit_slices(merged.drop(*slices), path, time, hours, state, mark)


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """A table with all columns that any of its files has, or None if there is nothing at ``path`` yet."""
    if is_table(spark, path):
        return read_table(spark, path)
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def stored_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A table, or None if there is nothing at ``path`` yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_report_store(rows: DataFrame, store: str, kind: str, zero_nulls: bool = False) -> None:
    """Replace the days of ``rows`` in one report table of the store."""
    commit_slices(store_form(rows, zero_nulls), f"{store.rstrip('/')}/{kind}", "Time")


def merge_report_store(rows: DataFrame, store: str, kind: str, zero_nulls: bool = False) -> None:
    """Add rows to one report table of the store; a report of the same device and
    time is replaced."""
    merge_slices(store_form(rows, zero_nulls), f"{store.rstrip('/')}/{kind}", ["Time", "DeviceName"], "Time")


def write_json_lines(rows: DataFrame, path: str) -> None:
    """Report rows as JSON lines."""
    rows.write.mode("append").json(path)
