"""Power curves: wind speed → power.

A curve is a few points (turbine_type, wind, power). It is cut into pieces, each
straight over a range of wind speeds, and rows find their piece by an equality
on a wind bin, so that no row is compared with all pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import send_with_tasks

send_with_tasks(__name__)

CURVE_SCHEMA = "turbine_type string, wind double, power double"
CUT_IN, CUT_OUT = 3.0, 25.0
LOW_WIND = 0.8
BIN = 0.5
TREES, SEED = 50, 45


def line_pieces(curves: DataFrame) -> DataFrame:
    """Straight lines between the points of each curve."""
    along = Window.partitionBy("turbine_type").orderBy("wind")
    before = F.lag("wind").over(along)
    return curves.dropna().select(
        "turbine_type",
        F.coalesce(before, F.col("wind") - BIN).alias("x0"),
        F.col("wind").alias("x1"),
        F.coalesce(F.lag("power").over(along), F.col("power")).alias("y0"),
        F.col("power").alias("y1"),
    )


def bootstrap_samples(points: int, trees: int, seed: int) -> np.ndarray:
    """Which points each tree of a seeded forest is grown on: trees × points.

    The draws are those of scikit-learn: a generator made from the seed gives
    every tree its own seed, and that seed draws the points with replacement.
    """
    seeds = np.random.RandomState(seed)
    drawn = np.zeros((trees, points), dtype=bool)
    for tree in range(trees):
        own = np.random.RandomState(seeds.randint(np.iinfo(np.int32).max))
        drawn[tree, own.randint(0, points, points)] = True
    return drawn


def forest_pieces(curves: DataFrame, trees: int = TREES, seed: int = SEED) -> DataFrame:
    """The curves as a regression forest over wind speed fits them.

    A tree grown to the end gives every wind the power of the nearest point it
    was grown on, and the lower one half way. So it is a staircase that jumps
    between neighbours, and the forest is the running sum of the jumps of all trees.
    """
    curve = Window.partitionBy("turbine_type")
    points = curves.dropna().select(
        "turbine_type", F.col("wind").cast("float").cast("double").alias("wind"),
        # decimals, as jumps up and down must cancel out
        F.col("power").cast("decimal(28,10)").alias("power"),
        F.count(F.lit(1)).over(curve).alias("n"), F.min("wind").over(curve).cast("float").cast("double").alias("lowest"),
        F.max("wind").over(curve).cast("float").cast("double").alias("highest"),
        # which points a tree draws depends on their order
        (F.row_number().over(curve.orderBy("wind", "power")) - 1).cast("long").alias("place"),
    )

    def draw(sizes: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sizes:
            for n in batch["n"]:
                tree, place = np.nonzero(bootstrap_samples(int(n), trees, seed))
                yield pd.DataFrame({"n": n, "tree": tree, "place": place})

    drawn = points.join(
        points.select("n").distinct().mapInPandas(draw, "n bigint, tree bigint, place bigint"), ["n", "place"])
    tree = Window.partitionBy("turbine_type", "tree").orderBy("wind", "place")
    before = F.lag("wind").over(tree)
    jumps = drawn.select(
        "turbine_type", "highest",
        F.coalesce((before + F.col("wind")) / 2, F.col("lowest") - BIN).alias("x0"),
        (F.col("power") - F.coalesce(F.lag("power").over(tree), F.lit(0).cast("decimal(28,10)"))).alias("jump"),
    ).unionByName(points.where("place = 0").select(
        "turbine_type", "highest", F.col("lowest").alias("x0"), F.lit(0).cast("decimal(29,10)").alias("jump")))
    stairs = jumps.groupBy("turbine_type", "highest", "x0").agg(F.sum("jump").alias("jump"))
    along = curve.orderBy("x0")
    height = F.sum("jump").over(along).cast("double") / trees
    return stairs.select(
        "turbine_type", "x0", F.coalesce(F.lead("x0").over(along), "highest").alias("x1"),
        height.alias("y0"), height.alias("y1"),
    ).where("x0 < x1")


FITS = {"line": line_pieces, "forest": forest_pieces}


def expected_power(rows: DataFrame, curves: DataFrame, wind: str, power: str, fit: str = "line") -> DataFrame:
    """Add ``power``, read off the curve of the row's type.

    Below its first point a curve gives the power of that point, above its last
    point the last; wind below 0 counts as 0. At or below 0.8 × cut-in, and from
    cut-out on, power is 0. Rows need ``turbine_type``, ``cut_in`` and
    ``cut_out``; a type without a curve gets null.
    """
    if fit not in FITS:
        raise ValueError(f"unknown fit {fit!r}; use one of {', '.join(FITS)}")
    pieces = FITS[fit](curves)
    ends = pieces.groupBy(F.col("turbine_type").alias("_type")).agg(
        F.min("x1").alias("_lowest"), F.max("x1").alias("_highest")
    )
    binned = pieces.select(
        F.col("turbine_type").alias("_curve"), "x0", "x1", "y0", "y1",
        F.explode(F.sequence(_bin(F.col("x0")), _bin(F.col("x1")))).alias("_bin"),
    )
    real = F.greatest(F.col(wind), F.lit(0.0))
    # a forest reads wind speeds in single precision
    seen = real.cast("float").cast("double") if fit == "forest" else real
    inside = F.least(F.greatest(seen, F.col("_lowest")), F.col("_highest"))
    placed = rows.join(ends, F.col("turbine_type") == F.col("_type"), "left").withColumn(
        "_wind", F.when(F.col(wind).isNotNull(), inside)
    )
    found = placed.join(
        binned,
        (F.col("turbine_type") == F.col("_curve"))
        & (_bin(F.col("_wind")) == F.col("_bin"))
        & (F.col("_wind") > F.col("x0"))
        & (F.col("_wind") <= F.col("x1")),
        "left",
    )
    slope = (F.col("y1") - F.col("y0")) / (F.col("x1") - F.col("x0"))
    on_piece = F.col("y0") + (F.col("_wind") - F.col("x0")) * slope
    idle = (real <= LOW_WIND * F.col("cut_in")) | (real >= F.col("cut_out"))
    value = F.when(F.col("x0").isNotNull(), F.when(idle, 0.0).otherwise(on_piece))
    return found.select(*rows.columns, value.alias(power))


def _bin(wind: Column) -> Column:
    return F.floor(wind / BIN)
