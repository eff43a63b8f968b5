"""Turbines of the same type whose mean wind is closest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .conditions import farm_key

WANTED = 2


def mean_winds(rows: DataFrame) -> DataFrame:
    """Mean wind per method, farm, type and turbine: a mean of window means."""
    return rows.groupBy("method", *farm_key(rows), "turbine_type", "turbine").agg(F.avg("wind_speed").alias("wind"))


def nearest_peers(winds: DataFrame) -> DataFrame:
    """The nearest and second nearest turbine of the type (and farm) by mean wind.

    Ties go to the smaller name. A turbine with fewer than two others, or of
    unknown type, gets none.
    Sorted by wind, the two nearest are among the neighbours on either side, so
    no pairs are formed: of equal winds the first three names can matter, of the
    next values up and down the first two, of the values beyond only the first.
    """
    kind = ["method", *farm_key(winds), "turbine_type"]
    same = Window.partitionBy(*kind, "wind").orderBy("turbine")
    values = Window.partitionBy(*kind).orderBy("wind")
    ranked = (
        winds.where(F.col("wind").isNotNull() & F.col("turbine_type").isNotNull())
        .withColumn("place", F.row_number().over(same))
        .withColumn("value", F.dense_rank().over(values))
        .withColumn("others", F.count(F.lit(1)).over(Window.partitionBy(*kind)) - 1)
    )

    def name(place: int, distance: int) -> Column:
        """The name in that place among turbines ``distance`` wind values away."""
        at = Window.partitionBy(*kind).orderBy("value").rangeBetween(distance, distance)
        held = F.when(F.col("place") == place, F.struct("turbine", "wind"))
        return F.min(held).over(at)

    spots = [(1, 0), (2, 0), (3, 0), (1, -1), (2, -1), (1, 1), (2, 1), (1, -2), (1, 2)]
    found = F.array(*[name(place, distance) for place, distance in spots])
    usable = F.filter(found, lambda peer: peer.isNotNull() & (peer["turbine"] != F.col("turbine")))
    by_distance = F.array_sort(
        F.transform(usable, lambda peer: F.struct(
            F.abs(peer["wind"] - F.col("wind")).alias("gap"), peer["turbine"].alias("peer")))
    )
    enough = F.col("others") >= WANTED
    return ranked.withColumn("_peers", by_distance).select(
        *kind, "turbine", "wind",
        F.when(enough, F.get(F.col("_peers"), F.lit(0))["peer"]).alias("nearest"),
        F.when(enough, F.get(F.col("_peers"), F.lit(1))["peer"]).alias("second"),
    )
