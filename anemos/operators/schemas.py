"""Schemas of files that are merged by column name."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import small_table


class Conflict(NamedTuple):
    """A column that two schemas give different types."""

    column: str
    left: str
    right: str


class SchemaConflict(ValueError):
    """Files cannot be merged, because a column has two types."""

    def __init__(self, conflicts: Sequence[Conflict]):
        self.conflicts = tuple(conflicts)
        text = ", ".join(f"{c.column}: {c.left} and {c.right}" for c in conflicts)
        super().__init__(f"columns with two types: {text}")


def conflicts_between(left: T.StructType, right: T.StructType) -> list[Conflict]:
    """Columns of the same name and another type. Types are never promoted:
    ``unionByName`` alone would widen numbers in silence and fail late on text."""
    types = {field.name: field.dataType.simpleString() for field in left.fields}
    return [
        Conflict(field.name, types[field.name], field.dataType.simpleString())
        for field in right.fields
        if types.get(field.name, field.dataType.simpleString()) != field.dataType.simpleString()
    ]


def merged_names(*schemas: T.StructType) -> list[str]:
    """All column names in order of first appearance; names of one character or
    none are dropped."""
    names = dict.fromkeys(name for schema in schemas for name in schema.fieldNames())
    return [name for name in names if len(name) > 1]


def merge_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both inputs under all columns of both; missing columns are null."""
    conflicts = conflicts_between(left.schema, right.schema)
    if conflicts:
        raise SchemaConflict(conflicts)
    names = merged_names(left.schema, right.schema)
    if set(left.columns) == set(right.columns):
        return left.select(*names).unionByName(right.select(*names))
    return left.unionByName(right, allowMissingColumns=True).select(*names)


def file_conflicts(file_columns: DataFrame) -> DataFrame:
    """Columns of files (file, column, type), how many files have them, with which types, and whether that keeps the files
    from being merged. Grouped in Spark: the number of files does not matter."""
    return file_columns.groupBy("column").agg(
        F.countDistinct("file").alias("files"),
        F.array_join(F.array_sort(F.collect_set("type")), ", ").alias("types"),
        (F.min("type") != F.max("type")).alias("conflict"),
    )


def schema_conflicts(spark: SparkSession, schemas: Iterable[T.StructType]) -> DataFrame:
    """Columns of any number of inputs, how many have them, with which types, and whether
    that keeps them from being merged."""
    rows = [(field.name, field.dataType.simpleString()) for schema in schemas for field in schema.fields]
    return small_table(spark, rows, "column string, type string").groupBy("column").agg(
        F.count(F.lit(1)).alias("files"),
        F.array_join(F.array_sort(F.collect_set("type")), ", ").alias("types"),
        (F.min("type") != F.max("type")).alias("conflict"),
    )
