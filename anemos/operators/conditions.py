"""Condition labels: the five-minute partial sums that every energy and
availability figure is made from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import time_bucket

# Condition labels with a meaning of their own.
INVALID = 0
NORMAL = 120
NO_DATA = 1000


def farm_key(df: DataFrame) -> list[str]:
    """The key of the farm: a column ``farm`` if the rows have one. Turbines of the
    same name in two farms are two turbines, and nothing is shared between farms."""
    return ["farm"] if "farm" in df.columns else []


def condition_sums(df: DataFrame, every: str = "5 MINUTE") -> DataFrame:
    """Sums per turbine (of a farm, if samples name it), window and label: the only pass over samples.

    From five-minute sums, five-minute rows, ten-minute rows and minutes per day
    are all made by adding up; for minutes alone, sums per day are enough. Only
    the signals in use are read.
    """
    window = time_bucket("time", every).alias("w")
    return df.groupBy(*farm_key(df), "turbine", window, F.col("MC531").alias("label")).agg(
        F.count("time").alias("samples"),
        F.sum("MC004").alias("wind_sum"),
        F.count("MC004").alias("wind_rows"),
        F.sum("MC209").alias("power_sum"),
        F.count("MC209").alias("power_rows"),
        F.count("MC132").alias("seconds"),
    )


def valid(sums: DataFrame) -> DataFrame:
    """Without the invalid label. A missing label is not invalid."""
    return sums.where((F.col("label") != INVALID) | F.col("label").isNull())


def prevailing_label() -> Column:
    """The label with the most ``samples``, the largest on ties; missing labels
    have no vote. Both go into one number, as a maximum of structs would make
    Spark sort instead of hash."""
    return F.max_by("label", F.col("samples") * 2**32 + F.col("label"))


def label_mode(sums: DataFrame) -> DataFrame:
    """The most frequent label per turbine and five minutes, the largest on ties.

    Missing labels have no vote. The counts come out of a hash aggregate, so no
    samples are sorted and no list of labels is collected.
    """
    farm = farm_key(sums)
    counted = sums.groupBy(*farm, "turbine", "w", "label").agg(F.sum("samples").alias("samples"))
    return counted.groupBy(*farm, "turbine", "w").agg(prevailing_label().alias("label"))
