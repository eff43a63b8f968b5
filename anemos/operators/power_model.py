"""Power curves learnt from telemetry: a regression forest per turbine type.

A forest is fitted on five-minute rows of turbines that ran normally (wind speed, power) and gives
the power of any wind by ``transform``, in place of a curve of fixed points. Spark grows the trees level by
level from histograms of the winds, so no task holds the rows of a type. Types are few, so
there is one fit for each.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .conditions import NORMAL
from .energy import CUT_IN, CUT_OUT, HOUR

TREES, SEED, DEPTH, BINS = 50, 45, 6, 64
LEAST_ROWS = 20


def _features(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=["wind_speed"], outputCol="_features").transform(rows)


def fit_power(rows: DataFrame, trees: int = TREES, seed: int = SEED, depth: int = DEPTH) -> dict[str, RandomForestRegressionModel]:
    """A forest per ``turbine_type``, of rows with wind_speed, power, label and turbine_type.

    Only rows in normal state with a wind and a power count. A type with fewer than ``LEAST_ROWS`` of them has no model.
    """
    sound = rows.where((F.col("label") == NORMAL) & F.col("wind_speed").isNotNull() & F.col("power").isNotNull()
                       & F.col("turbine_type").isNotNull()).select("turbine_type", "wind_speed", "power")
    sound = materialize(sound, "power-samples")
    types = sorted(row["turbine_type"] for row in sound.groupBy("turbine_type").count().where(F.col("count") >= LEAST_ROWS).collect())
    forest = RandomForestRegressor(
        featuresCol="_features", labelCol="power", predictionCol="_model_power", numTrees=trees, seed=seed, maxDepth=depth, maxBins=BINS)
    return {name: forest.fit(_features(sound.where(F.col("turbine_type") == name))) for name in types}


def with_model_power(rows: DataFrame, models: Mapping[str, RandomForestRegressionModel], power: str = "model_power") -> DataFrame:
    """Add the power that the model of the row's type expects of its wind: 0 below four fifths of the cut-in speed and from
    the cut-out speed on, null without a model or a wind."""
    parts = []
    for name, model in models.items():
        part = rows.where((F.col("turbine_type") == name) & F.col("wind_speed").isNotNull())
        parts.append(model.transform(_features(part)).drop("_features"))
    known = F.col("turbine_type").isin(*models) & F.col("wind_speed").isNotNull() if models else F.lit(False)
    left = rows.where(~F.coalesce(known, F.lit(False))).withColumn("_model_power", F.lit(None).cast("double"))
    for part in parts:
        left = left.unionByName(part)
    cut_in = F.coalesce("cut_in", F.lit(CUT_IN)) if "cut_in" in rows.columns else F.lit(CUT_IN)
    cut_out = F.coalesce("cut_out", F.lit(CUT_OUT)) if "cut_out" in rows.columns else F.lit(CUT_OUT)
    still = (F.greatest(F.col("wind_speed"), F.lit(0.0)) <= 0.8 * cut_in) | (F.col("wind_speed") >= cut_out)
    made = F.when(F.col("_model_power").isNotNull() & still, F.lit(0.0)).otherwise(F.col("_model_power"))
    return left.withColumn(power, made).drop("_model_power")


def with_model_energy(rows: DataFrame, models: Mapping[str, RandomForestRegressionModel]) -> DataFrame:
    """Add ``expected``, the energy that the models expect of rows with wind_speed and seconds."""
    rows = with_model_power(rows, models)
    return rows.withColumn("expected", F.col("model_power") * F.col("seconds") / HOUR).drop("model_power")
