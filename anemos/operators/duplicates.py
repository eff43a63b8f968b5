"""Duplicate rows and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct row, or per key."""
    return df.dropDuplicates(list(keys) if keys else None)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once, with ``copies``, the number of rows.

    Counting is combined map-side and the rows are joined back, so a key that
    holds a large share of the rows is never gathered in one task: a join can be
    split on a hot key, a window cannot.
    """
    counts = (
        df.groupBy(*[F.col(key).alias(f"_{key}") for key in keys])
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    same = F.lit(True)
    for key in keys:
        same = same & df[key].eqNullSafe(F.col(f"_{key}"))
    return df.join(counts, same).select(*df.columns, "copies")
