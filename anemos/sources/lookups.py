"""Small tables read from text files, and the built-in power curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.curves import CURVE_SCHEMA
from ..session import small_table

# Power (kW) of the two standard curves at wind 3.0, 3.5, … 25.0 m/s.
CURVE_FIRST_WIND, CURVE_STEP = 3.0, 0.5
CURVE_8MW = (
    105.7, 218.3, 360.7, 554.4, 801.8, 1104.4, 1461.1, 1869.3, 2339.4, 2874.6, 3485.7, 4183.9,
    4929.7, 5709.0, 6466.5, 7033.0, 7403.3, 7627.4, 7761.6, 7843.3, 7894.2, 7928.1, 7954.3, 7981.2,
) + (8000.0,) * 21
CURVE_10MW = (
    124.58848, 253.89064, 418.33487, 646.1822, 942.1466, 1308.9038, 1745.5771, 2249.0266, 2817.1658,
    3461.3635, 4196.869, 5039.7974, 5954.933, 6907.8545, 7836.535, 8666.227, 9231.428, 9547.541,
    9725.123, 9841.267, 9918.096, 9968.743,
) + (10000.0,) * 23


def standard_curves(spark: SparkSession, types: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
    """(turbine_type, wind, power) from evenly spaced power values per type."""
    types = types or {"8MW": CURVE_8MW, "10MW": CURVE_10MW}
    rows = [
        (kind, CURVE_FIRST_WIND + CURVE_STEP * i, power)
        for kind, powers in types.items() for i, power in enumerate(powers)
    ]
    return small_table(spark, rows, CURVE_SCHEMA)


def read_curves(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of power curves with a header."""
    return spark.read.csv(path, header=True, schema=CURVE_SCHEMA)


def read_condition_labels(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated list of condition labels: number and text, with a header."""
    return spark.read.csv(path, header=True, sep="\t", schema="label int, label_text string")


def read_grid_dates(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of (turbine, on_grid, trial_end) times; rows without a trial end are left out."""
    return spark.read.csv(
        path, header=True, schema="turbine string, on_grid timestamp_ntz, trial_end timestamp_ntz"
    ).dropna(subset=["trial_end"])


def read_turbine_info(spark: SparkSession, path: str, farm: str) -> DataFrame:
    """Type and speeds of the turbines of one farm, from a CSV of all farms."""
    table = spark.read.csv(
        path, header=True,
        schema="farm string, turbine string, turbine_type string, cut_in double, cut_out double",
    )
    return table.where(F.col("farm") == farm).drop("farm")
