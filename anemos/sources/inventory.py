"""What is in a folder of Parquet files, read from the footers only."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import send_with_tasks

send_with_tasks(__name__)

_COLUMN = (
    "name string, path string, max_definition_level int, max_repetition_level int, physical_type string, "
    "logical_type string, compression string, total_uncompressed_size bigint, total_compressed_size bigint, "
    "space_saved string, encodings array<string>"
)
INVENTORY_SCHEMA = f"file string, {_COLUMN}"


def _footer_rows(uri: str) -> Iterator[dict]:
    """One record per leaf column of a file, sizes summed over its row groups."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    filesystem, path = pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    with filesystem.open_input_file(path) as handle:
        footer = pq.ParquetFile(handle).metadata
        for at in range(footer.num_columns):
            column = footer.schema.column(at)
            chunks = [footer.row_group(group).column(at) for group in range(footer.num_row_groups)]
            full = sum(chunk.total_uncompressed_size for chunk in chunks)
            packed = sum(chunk.total_compressed_size for chunk in chunks)
            yield {
                "file": uri,
                "name": column.name,
                "path": column.path,
                "max_definition_level": column.max_definition_level,
                "max_repetition_level": column.max_repetition_level,
                "physical_type": column.physical_type,
                "logical_type": column.logical_type.type,
                "compression": chunks[0].compression if chunks else None,
                "total_uncompressed_size": full,
                "total_compressed_size": packed,
                "space_saved": f"{(1 - packed / full) * 100:.2f}%" if full else None,
                "encodings": sorted({name for chunk in chunks for name in chunk.encodings}),
            }


def list_files(spark: SparkSession, folder: str, allowed: Sequence[str] | None = None) -> DataFrame:
    """Paths of the Parquet files below a folder; with ``allowed``, only those
    below one of these base folders and without ``..``."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .select("path")
    )
    if allowed is None:
        return files
    bare = F.regexp_replace("path", "^[a-z0-9]+:/*", "/")
    below = F.lit(False)
    for base in allowed:
        below = below | bare.startswith(base.rstrip("/") + "/")
    return files.where(below & ~F.col("path").contains(".."))


def file_inventory(files: DataFrame) -> DataFrame:
    """Column records of all files; executors read footers, never data."""
    arrow = pa.schema([
        ("file", pa.string()), ("name", pa.string()), ("path", pa.string()),
        ("max_definition_level", pa.int32()), ("max_repetition_level", pa.int32()),
        ("physical_type", pa.string()), ("logical_type", pa.string()), ("compression", pa.string()),
        ("total_uncompressed_size", pa.int64()), ("total_compressed_size", pa.int64()),
        ("space_saved", pa.string()), ("encodings", pa.list_(pa.string())),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist(list(_footer_rows(uri)), schema=arrow)

    return files.select("path").mapInArrow(read, INVENTORY_SCHEMA)


# Spark's names of the types that files state, where they differ from Arrow's.
_SPARK_NAMES = {
    "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "bool": "boolean", "date32[day]": "date",
    "timestamp[us]": "timestamp_ntz", "timestamp[ms]": "timestamp_ntz", "large_string": "string",
}


def _schema_rows(uri: str) -> Iterator[dict]:
    """One record per top-level column of a file."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq
    import pyarrow.types as types

    def named(kind: pa.DataType) -> str:
        if types.is_list(kind) or types.is_large_list(kind):
            return f"array<{named(kind.value_type)}>"
        if types.is_struct(kind):
            return f"struct<{','.join(f'{field.name}:{named(field.type)}' for field in kind)}>"
        if types.is_decimal(kind):
            return f"decimal({kind.precision},{kind.scale})"
        return "timestamp" if types.is_timestamp(kind) and kind.tz else _SPARK_NAMES.get(str(kind), str(kind))

    filesystem, path = pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    with filesystem.open_input_file(path) as handle:
        for field in pq.read_schema(handle):
            yield {"file": uri, "column": field.name, "type": named(field.type)}


def file_schemas(files: DataFrame) -> DataFrame:
    """file, column and type (in Spark's words) of every column of every file, from the footers."""
    arrow = pa.schema([("file", pa.string()), ("column", pa.string()), ("type", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist(list(_schema_rows(uri)), schema=arrow)

    return files.select("path").mapInArrow(read, "file string, column string, type string")


def type_conflicts(inventory: DataFrame) -> DataFrame:
    """Columns, the types files give them, and whether those files can be merged.

    The check of :func:`anemos.operators.schemas.merge_by_name` for any number of
    files at once.
    """
    kind = F.concat_ws(" ", "physical_type", "logical_type")
    return inventory.groupBy(F.col("path").alias("column")).agg(
        F.count(F.lit(1)).alias("files"),
        F.array_sort(F.collect_set(kind)).alias("types"),
        (F.min(kind) != F.max(kind)).alias("conflict"),
    )
