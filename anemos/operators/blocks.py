"""Report totals that merge without loss, kept per turbine for blocks of several lengths.

A block holds what the metrics of its samples are made of: counts, sums, bounds, and the first and
last meter reading with their times. Blocks of ten minutes are made from samples, longer ones from
shorter ones, and any time range that begins and ends on ten minutes is covered by few blocks: a year by
twelve, any range by at most five blocks of ten minutes, 23 hours and 30 days on either side of
its months. A metric made from the blocks of a range is the one made from its samples.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import naive, time_bucket
from . import metrics
from .periods import period_grid, period_of
from .reports import KEYS, file_keys, report_of
from .rollup import Groups, add_formulas, group_names, group_table, period_cover, period_first

# Levels of blocks from short to long, and their length.
LEVELS = {"10min": "10 MINUTE", "hour": "1 HOUR", "day": "1 DAY", "month": "1 MONTH"}
# The blocks that the periods of a report are made of.
PERIOD_LEVELS = {**{level: level for level in LEVELS}, "year": "month"}
_FIRST, _LAST = "_first_time", "_last_time"


def parts() -> dict[str, tuple[str, str]]:
    """What a block holds: for each column the aggregate over samples, and over blocks.

    A mean is a sum and a count. Like :func:`metrics.totals` it takes no sort and its
    buffer stays below the 100 columns that Spark compiles.
    """
    result = {_FIRST: ("min(time)", f"min({_FIRST})"), _LAST: ("max(time)", f"max({_LAST})")}
    for name, expression in metrics.totals().items():
        function, _, inside = expression.partition("(")
        if function == "avg":
            result[f"_sum_{name}"] = (f"sum({inside}", f"sum(_sum_{name})")
            result[f"_n_{name}"] = (f"count({inside}", f"sum(_n_{name})")
        elif function in ("max_by", "min_by"):
            result[name] = (expression, f"{function}({name}, {_LAST if function == 'max_by' else _FIRST})")
        else:
            result[name] = (expression, f"{'sum' if function == 'count' else function}({name})")
    return result


def _block_columns(of: int) -> list[Column]:
    return [F.expr(f"{pair[of]} AS `{name}`") for name, pair in parts().items()]


def sample_blocks(samples: DataFrame, every: str = LEVELS["10min"]) -> DataFrame:
    """Blocks of ten minutes, from one pass over the samples."""
    keys = [time_bucket("time", every).alias("Time"), F.col("turbine").alias("DeviceName")]
    return samples.groupBy(*keys).agg(*_block_columns(0)).withColumn("_windows", F.lit(1).cast("bigint"))


def file_blocks(arrivals: DataFrame) -> DataFrame:
    """What each arriving file adds to the report of its device and ten minutes, which its name tells."""
    return arrivals.groupBy(*file_keys(), "file_path").agg(*_block_columns(0)).withColumn("_windows", F.lit(1).cast("bigint"))


def merged_blocks(blocks: DataFrame, *keys: Column | str) -> DataFrame:
    """Blocks with the same keys as one; ``_windows`` counts the ten minutes that had samples."""
    return blocks.groupBy(*keys).agg(*_block_columns(1), F.sum("_windows").alias("_windows"))


def longer_blocks(blocks: DataFrame, level: str) -> DataFrame:
    """Blocks of a level from those of a shorter one."""
    return merged_blocks(blocks, time_bucket("Time", LEVELS[level]).alias("Time"), "DeviceName")


def block_totals(blocks: DataFrame) -> DataFrame:
    """Blocks with the columns of :func:`reports.window_totals`, and what adds up over turbines."""
    means = [F.expr(f"try_divide(_sum_{name}, _n_{name}) AS `{name}`")
             for name, expression in metrics.totals().items() if expression.startswith("avg(")]
    delivered = "(GriActiveEnergyDelLast - PreTotalGenerationFirst)"
    made = "(_meter_last - _meter_before)"
    lost = " + ".join(f"_{loss}" for loss in metrics.LOSSES if loss != "LimitLossGeneration")
    added = {
        "_delivered": delivered, "_received": "GriActiveEnergyRcvLast - PreTotalEleConsumptionFirst",
        "_equivalent": f"try_divide(CAST({delivered} AS DOUBLE), RatedPowerData) * 3600", "_made": made,
        "_expected": f"CASE WHEN {made} IS NOT NULL THEN TheoreticalGeneration END",
        "_lost": f"CASE WHEN {made} IS NOT NULL THEN {lost} END",
    }
    return blocks.select("*", *means, *[F.expr(f"{expression} AS `{name}`") for name, expression in added.items()])


_ADDED = ("_delivered", "_received", "_equivalent", "_made", "_expected", "_lost", "_windows")


def block_formulas() -> dict[str, str]:
    """Report columns over the totals of any number of ten-minute windows and turbines."""
    def ratio(top: str, bottom: str) -> str:
        return f"try_divide(CAST({top} AS DOUBLE), {bottom})"

    return metrics.derived() | {
        "GriActiveEnergyDelTotal": "_delivered", "GriActiveEnergyRcvSection": "_received", "EquivalentHours": "_equivalent",
        "InterruptionDurationCalculated": f"{metrics.FULL_WINDOW_SECONDS} * _windows - _rows",
        "EnergyAvailability": f"{ratio('_made', '_expected')} * 3600 * 100",
        "Discrepancy": f"(1 - {ratio('_made', '(_made + _lost / 3600)')}) * 100",
    }


def block_reports(blocks: DataFrame, columns: Sequence[str] = metrics.COMBINED_COLUMNS) -> DataFrame:
    """Report rows of blocks of any length, one per turbine and block."""
    return report_of(block_totals(blocks), columns, formulas=block_formulas())


def _of_turbines(totals: DataFrame, *keys: str) -> DataFrame:
    """Totals of several turbines as one: what is counted or made adds up, means weigh by their samples."""
    columns = []
    for name, expression in metrics.totals().items():
        function = expression.partition("(")[0]
        if function == "avg":
            columns.append(f"try_divide(sum(_sum_{name}), sum(_n_{name})) AS `{name}`")
        elif function not in ("max_by", "min_by"):
            columns.append(f"{'sum' if function == 'count' else function}({name}) AS `{name}`")
    columns += [f"sum({name}) AS `{name}`" for name in _ADDED]
    return totals.groupBy(*keys).agg(*map(F.expr, columns))


def exact_rollup(
    blocks: Mapping[str, DataFrame], groups: Groups, period: str, start: dt.datetime, end: dt.datetime,
    columns: Sequence[str], formulas: Mapping[str, str] | None = None,
) -> DataFrame:
    """One report row per group and period, made from the blocks of that length (a year from months).

    Per turbine each value is what the samples of the period give. Over turbines seconds, counts and energies add up,
    ratios are made from the sums. Each group gets a row for every period of the grid.
    """
    level = blocks[PERIOD_LEVELS[period]]
    spark = level.sparkSession
    covered = (F.col("Time") >= period_first(start, period)) & (F.col("Time") < period_cover(start, end, period))
    picked = level.where(covered).join(group_table(spark, groups), F.col("DeviceName") == F.col("device"))
    picked = picked.withColumn("period_start", period_of(F.col("Time"), naive(start), period))
    rows = _group_rows(merged_blocks(picked, "group_ord", "period_start", "DeviceName"), columns, "group_ord", "period_start")
    grid = period_grid(
        group_names(spark, groups).select("*", naive(start).alias("_start"), naive(end).alias("_end")), period, "_start", "_end")
    values = [name for name in columns if name not in KEYS]
    result = grid.join(rows, ["group_ord", "period_start"], "left").select(
        "group_ord", F.col("period_start").alias("Time"), F.col("group_name").alias("DeviceName"), *values)
    return add_formulas(result, formulas or {}, ["Time", "DeviceName", *values])


def exact_range(
    blocks: Mapping[str, DataFrame], groups: Groups, start: dt.datetime, end: dt.datetime,
    columns: Sequence[str], formulas: Mapping[str, str] | None = None,
) -> DataFrame:
    """One report row per group for a whole range, from the fewest blocks that cover it; as :func:`exact_rollup`."""
    picked = covering_blocks(blocks, start, end)
    spark = picked.sparkSession
    picked = picked.join(group_table(spark, groups), F.col("DeviceName") == F.col("device"))
    rows = _group_rows(merged_blocks(picked, "group_ord", "DeviceName"), columns, "group_ord")
    values = [name for name in columns if name not in KEYS]
    result = group_names(spark, groups).join(rows, "group_ord", "left").select(
        "group_ord", naive(start).alias("Time"), F.col("group_name").alias("DeviceName"), *values)
    return add_formulas(result, formulas or {}, ["Time", "DeviceName", *values])


def _group_rows(per_turbine: DataFrame, columns: Sequence[str], *keys: str) -> DataFrame:
    totals = _of_turbines(block_totals(per_turbine), *keys)
    formulas = block_formulas()
    values = [name for name in columns if name not in KEYS]
    return totals.selectExpr(*keys, *[
        "Count" if name == "Count" else f"CAST({formulas.get(name, name)} AS DOUBLE) AS `{name}`" for name in values])


# --- covering a range -------------------------------------------------------


def _block_start(moment: dt.datetime, level: str) -> dt.datetime:
    if level == "10min":
        return moment.replace(minute=moment.minute - moment.minute % 10, second=0, microsecond=0)
    if level == "hour":
        return moment.replace(minute=0, second=0, microsecond=0)
    midnight = moment.replace(hour=0, minute=0, second=0, microsecond=0)
    return midnight.replace(day=1) if level == "month" else midnight


def _next_start(moment: dt.datetime, level: str) -> dt.datetime:
    """The first start of a block at or after a moment."""
    first = _block_start(moment, level)
    if first == moment:
        return moment
    if level == "month":
        return (first + dt.timedelta(days=32)).replace(day=1)
    return first + {"10min": dt.timedelta(minutes=10), "hour": dt.timedelta(hours=1), "day": dt.timedelta(days=1)}[level]


def cover(start: dt.datetime, end: dt.datetime) -> list[tuple[str, dt.datetime, dt.datetime]]:
    """The fewest blocks that make up a range, as runs (level, first start, end), in order of time.

    Both ends must lie on ten minutes.
    """
    if _block_start(start, "10min") != start or _block_start(end, "10min") != end:
        raise ValueError("a range of blocks begins and ends on ten minutes")
    levels = list(LEVELS)

    def split(low: dt.datetime, high: dt.datetime, at: int) -> list[tuple[str, dt.datetime, dt.datetime]]:
        if low >= high:
            return []
        if at + 1 == len(levels):
            return [(levels[at], low, high)]
        inner_low, inner_high = _next_start(low, levels[at + 1]), _block_start(high, levels[at + 1])
        if inner_low >= inner_high:
            return [(levels[at], low, high)]
        edges = [(levels[at], a, b) for a, b in ((low, inner_low), (inner_high, high)) if a < b]
        return sorted([*edges, *split(inner_low, inner_high, at + 1)], key=lambda run: run[1])

    return split(start, end, 0)


def covering_blocks(blocks: Mapping[str, DataFrame], start: dt.datetime, end: dt.datetime) -> DataFrame:
    """The blocks of :func:`cover`. The times are filters, which reach the scans."""
    picked = None
    for level, low, high in cover(start, end):
        rows = blocks[level].where((F.col("Time") >= naive(low)) & (F.col("Time") < naive(high))).select(
            *KEYS, *parts(), "_windows")
        picked = rows if picked is None else picked.unionByName(rows)
    if picked is None:
        picked = blocks["10min"].where(F.lit(False)).select(*KEYS, *parts(), "_windows")
    return picked
