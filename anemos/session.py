"""Session defaults and the one place where intermediate tables are written."""

from __future__ import annotations

import re
import sys
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

_scope = threading.local()
_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(app: str = "anemos", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library is tested with.

    ``conf`` keys use ``__`` for ``.``, e.g. ``spark__sql__shuffle__partitions="8"``.
    Nothing in the library depends on this function; any session in zone UTC will do.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**_DEFAULTS, **{key.replace("__", "."): value for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, but only if the
    session runs in this one process; on a cluster that would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="anemos-")
    return _local_scratch.name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table or folder in whatever store it lies; nothing happens if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end. For jobs that write
    their result inside; a DataFrame handed out would lose the tables it reads."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        for path in _scope.paths:
            delete_path(spark, path)
        _scope.paths = outer


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches of a plan need the same reduced rows: column
    pruning makes the branches differ, so Spark would otherwise scan the raw
    data once per branch. The table outlives lost executors and cuts lineage. It
    stays until the end of the :func:`scratch_scope` around the call, if there is one.
    """
    path = scratch_path(df.sparkSession, label)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows of a request as a DataFrame whose size Spark knows.

    Tables made from Python rows count as unboundedly large; handed over as Arrow
    they stay local, and joins with them are broadcast as long as they are small.
    """
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    table = pa.table({
        field.name: pa.array(column, to_arrow_type(field.dataType)) for field, column in zip(fields, columns)
    })
    return spark.createDataFrame(table, fields)


def send_with_tasks(module: str) -> None:
    """Ship the functions of a module along with the tasks that call them, so
    that executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
