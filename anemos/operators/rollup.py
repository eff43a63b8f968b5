"""Report rows merged over periods and groups of turbines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.buckets import naive
from ..functions.formulas import formula_column
from ..session import small_table
from . import metrics
from .periods import PERIODS, grid_start, period_grid, period_of

Groups = Sequence[Mapping[str, Sequence[str]]]

KEYS = ("Time", "DeviceName")
RULES = ("by_name", "additive")


def group_table(spark: SparkSession, groups: Groups) -> DataFrame:
    """A request's groups as (group_ord, group_name, device), each device once per group."""
    rows, order = [], 0
    for item in groups:
        for name, devices in item.items():
            rows += [(order, name, device) for device in dict.fromkeys(devices)] or [(order, name, None)]
            order += 1
    return small_table(spark, rows, "group_ord int, group_name string, device string")


def group_names(spark: SparkSession, groups: Groups) -> DataFrame:
    """A request's groups as (group_ord, group_name)."""
    names = [name for item in groups for name in item]
    return small_table(spark, list(enumerate(names)), "group_ord int, group_name string")


def merge_rule(column: str) -> str:
    """How a column merges, told by its name; the first match wins."""
    name = column.lower()
    for rule in ("max", "min", "avg"):
        if rule in name:
            return rule
    return "sum" if "sum" in name or "total" in name else "avg"


def merge_columns(df: DataFrame, columns: Sequence[str], rules: str = "by_name") -> list[Column]:
    """Aggregates for ``columns``. A column that is no number keeps its first value by
    time and device. ``rules`` is ``"by_name"`` (see :func:`merge_rule`) or
    ``"additive"``: what the report's own columns count is added up and their ratios
    are made anew from sums, for which all that they read must be in ``df``; other
    columns merge by name."""
    if rules not in RULES:
        raise ValueError(f"unknown rules {rules!r}")
    added = metrics.additive() if rules == "additive" else {}

    def merged(name: str) -> str:
        if not isinstance(df.schema[name].dataType, T.NumericType):
            return f"min_by(`{name}`, struct({', '.join(KEYS)}))"
        if name not in added:
            return f"{merge_rule(name)}(CAST(`{name}` AS DOUBLE))"
        expression, inputs = added[name]
        missing = sorted(set(inputs) - set(df.columns))
        if missing:
            raise ValueError(f"{name} cannot be added up without {', '.join(missing)}")
        return f"CAST({expression} AS DOUBLE)"

    return [F.expr(f"{merged(name)} AS `{name}`") for name in columns]


def add_formulas(df: DataFrame, formulas: Mapping[str, str], visible: Sequence[str] | None = None) -> DataFrame:
    """Add a column per formula. Formulas see the columns of ``df`` only, so
    their order does not matter."""
    visible = df.columns if visible is None else visible
    if not formulas:
        return df
    kinds = {name: kind for name, kind in df.dtypes if name in set(visible)}
    return df.withColumns({name: formula_column(text, kinds) for name, text in formulas.items()})


def rollup(
    rows: DataFrame,
    groups: Groups,
    period: str,
    start: dt.datetime,
    end: dt.datetime,
    columns: Sequence[str] | None = None,
    formulas: Mapping[str, str] | None = None,
    rules: str = "by_name",
) -> DataFrame:
    """Stored ten-minute rows merged per group and period, by the rules of :func:`merge_columns`.

    Each group gets a row for every period of the grid, also where it has no data.
    """
    values = [name for name in dict.fromkeys(rows.columns if columns is None else columns) if name not in KEYS]
    devices = group_table(rows.sparkSession, groups)
    grid = period_grid(
        group_names(rows.sparkSession, groups).select(
            "*", naive(start).alias("_start"), naive(end).alias("_end")
        ),
        period, "_start", "_end",
    )
    covered = F.col("Time") < period_cover(start, end, period)
    picked = rows.where((F.col("Time") >= period_first(start, period)) & covered)
    merged = (
        picked.join(devices, F.col("DeviceName") == F.col("device"))
        .withColumn("period_start", period_of(F.col("Time"), naive(start), period))
        .groupBy("group_ord", "period_start")
        .agg(*merge_columns(picked, values, rules))
    )
    result = grid.join(merged, ["group_ord", "period_start"], "left").select(
        "group_ord", F.col("period_start").alias("Time"), F.col("group_name").alias("DeviceName"), *values
    )
    return add_formulas(result, formulas or {}, ["Time", "DeviceName", *values])


def period_first(start: dt.datetime, period: str) -> Column:
    """Where the grid of a request begins."""
    return grid_start(naive(start), period)


def period_cover(start: dt.datetime, end: dt.datetime, period: str) -> Column:
    """Where the last period of a request ends, which may be after ``end``."""
    last = period_of(naive(end) - F.expr("INTERVAL '1' MICROSECOND"), naive(start), period)
    return last + F.expr(PERIODS[period][1])


def ad_hoc_rollup(slices: DataFrame, groups: Groups, start: dt.datetime,
                  formulas: Mapping[str, str] | None = None) -> DataFrame:
    """Per-device daily slices merged to one row per group, stamped with ``start``."""
    devices = group_table(slices.sparkSession, groups)
    values = [name for name in slices.columns if name not in KEYS]
    merged = (
        slices.join(devices, F.col("DeviceName") == F.col("device"))
        .groupBy("group_ord")
        .agg(*merge_columns(slices, values))
    )
    names = group_names(slices.sparkSession, groups)
    result = names.join(merged, "group_ord", "left").select(
        "group_ord", naive(start).alias("Time"), F.col("group_name").alias("DeviceName"), *values
    )
    return add_formulas(result, formulas or {}, ["Time", "DeviceName", *values])
