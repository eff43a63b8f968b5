"""Energy availability: actual, expected, potential and lost energy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import time_bucket
from .conditions import NORMAL, farm_key, prevailing_label, valid
from .curves import CUT_IN, CUT_OUT, expected_power
from .peers import mean_winds, nearest_peers

FIVE, TEN = "five_minute", "ten_minute"
HOUR = 3600.0


def _mean(stem: str) -> Column:
    return F.try_divide(F.sum(f"{stem}_sum"), F.sum(f"{stem}_rows"))


def _window_rows(groups, *extra: Column) -> DataFrame:
    return groups.agg(
        _mean("wind").alias("wind_speed"),
        _mean("power").alias("power"),
        F.sum("seconds").alias("seconds"),
        *extra,
    )


def five_minute_rows(sums: DataFrame) -> DataFrame:
    """Mean wind and power, seconds and prevailing label per turbine and five minutes."""
    rows = _window_rows(valid(sums).groupBy(*farm_key(sums), "turbine", "w"), prevailing_label().alias("label"))
    return _energy(rows, FIVE)


def ten_minute_rows(sums: DataFrame) -> DataFrame:
    """The same per turbine, ten minutes and label."""
    window = time_bucket("w", "10 MINUTE").alias("w")
    rows = _window_rows(valid(sums).where(F.col("label").isNotNull()).groupBy(*farm_key(sums), "turbine", window, "label"))
    return _energy(rows, TEN)


def _energy(rows: DataFrame, method: str) -> DataFrame:
    return rows.where(F.col("wind_speed").isNotNull()).select(
        F.lit(method).alias("method"), *farm_key(rows), "turbine", "w", "label", "wind_speed", "power", "seconds",
        (F.col("power") * F.col("seconds") / HOUR).alias("actual"),
    )


def with_turbine_info(rows: DataFrame, info: DataFrame) -> DataFrame:
    """Add type and speeds of the turbine; speeds are whole, 3 and 25 where unknown."""
    def speed(name: str, default: float) -> Column:
        return F.coalesce(F.col(name).cast("int").cast("double"), F.lit(default)).alias(name)

    own = [*(name for name in farm_key(info) if name in rows.columns), "turbine"]
    known = info.select(*own, "turbine_type", speed("cut_in", CUT_IN), speed("cut_out", CUT_OUT))
    return rows.join(known, own, "left").fillna({"cut_in": CUT_IN, "cut_out": CUT_OUT})


def with_expected(rows: DataFrame, info: DataFrame, curves: DataFrame,
                  international: DataFrame | None = None, fit: str = "line") -> DataFrame:
    """Add expected energy by the type's curve and by a second, international curve
    (0 where there is none). ``fit`` is how curves are read between their points."""
    rows = expected_power(with_turbine_info(rows, info), curves, "wind_speed", "_power", fit)
    rows = rows.withColumn("expected", F.col("_power") * F.col("seconds") / HOUR).drop("_power")
    if international is None:
        return rows.withColumn("intl_expected", F.lit(0.0))
    rows = expected_power(rows, international, "wind_speed", "_power", fit)
    return rows.withColumn("intl_expected", F.coalesce(F.col("_power") * F.col("seconds") / HOUR, F.lit(0.0))).drop("_power")


def with_potential(rows: DataFrame) -> DataFrame:
    """Add potential energy: what a turbine out of normal state would have made.

    Five-minute rows take the energy of the nearest turbine that ran normally at
    the time, else of the second nearest; then, like ten-minute rows, the mean of
    all other normal turbines of the type; then the expected energy. Energy of a
    peer is scaled to the row's seconds. Normal rows have their expected energy.

    ``rows`` (both methods, from :func:`with_expected`) is read several times:
    pass a table, not a plan over samples. Only rows out of normal state are
    joined; normal rows pass through.
    """
    farm = farm_key(rows)
    normal = rows.where(F.col("label") == NORMAL)
    other = rows.where((F.col("label") != NORMAL) | F.col("label").isNull())
    peers = nearest_peers(mean_winds(rows.where(F.col("method") == FIVE))).select(
        "method", *farm, "turbine", "nearest", "second"
    )
    # What each normal turbine of the type made in the window: as many entries as a farm has turbines.
    entry = F.when(F.col("turbine").isNotNull(), F.struct(F.col("turbine"), F.struct("actual", "seconds")))
    per_type = normal.groupBy("method", *farm, "turbine_type", "w").agg(
        F.sum("actual").alias("_actual"), F.count("actual").alias("_actual_rows"),
        F.sum("seconds").alias("_seconds"), F.count("seconds").alias("_seconds_rows"),
        F.map_from_entries(F.collect_list(entry)).alias("_made"),
    )
    joined = other.join(peers, ["method", *farm, "turbine"], "left").join(
        per_type, ["method", *farm, "turbine_type", "w"], "left")

    def made(turbine: str, name: str) -> Column:
        return F.try_element_at("_made", F.col(turbine))[name]

    def of_others(name: str) -> Column:
        """Mean over the type without the turbine's own normal row of the window."""
        own = made("turbine", name)
        total = F.col(f"_{name}") - F.coalesce(own, F.lit(0))
        return F.try_divide(total, F.col(f"_{name}_rows") - F.when(own.isNotNull(), 1).otherwise(0))

    def scaled(energy: Column, seconds: Column) -> Column:
        return F.try_divide(energy * F.col("seconds"), seconds.cast("double"))

    by_peer = F.coalesce(
        scaled(made("nearest", "actual"), made("nearest", "seconds")),
        scaled(made("second", "actual"), made("second", "seconds")),
        scaled(of_others("actual"), of_others("seconds")),
    )
    filled = joined.select(
        *rows.columns,
        F.coalesce(by_peer, "expected").alias("potential"),
        F.coalesce(by_peer, "intl_expected").alias("intl_potential"),
    )
    return normal.select("*", F.col("expected").alias("potential"),
                         F.col("intl_expected").alias("intl_potential")).unionByName(filled)


# Energy column → column of the daily table.
_SUMS = {
    "actual": "actual_generation",
    "expected": "theoretical_generation",
    "seconds": "seconds",
    "intl_expected": "intl_theoretical_generation",
    "potential": "potential_generation",
    "intl_potential": "intl_potential_generation",
    "loss": "loss_amount",
    "intl_loss": "intl_loss_amount",
}


def daily_energy(rows: DataFrame, farm: str = "farm") -> DataFrame:
    """Mean wind and sums of energy per day, method, turbine and label.

    Loss is what potential energy exceeds actual energy by. Missing values count
    nothing; rows without a label are left out.
    """
    loss = F.greatest(F.col("potential") - F.col("actual"), F.lit(0.0))
    intl_loss = F.greatest(F.col("intl_potential") - F.col("actual"), F.lit(0.0))
    sums = [F.coalesce(F.sum(name), F.lit(0).cast("double" if name != "seconds" else "bigint")).alias(title)
            for name, title in _SUMS.items()]
    daily = (
        rows.where(F.col("label").isNotNull())
        .withColumns({"loss": loss, "intl_loss": intl_loss, "record_date": F.to_date("w")})
        .groupBy(
            F.date_format("record_date", "yyyy-MM").alias("record_month"), "record_date",
            F.lit("PBA").alias("record_type"), F.col("method").alias("standard_abbr"), *farm_key(rows), "turbine", "label",
        )
        .agg(F.avg("wind_speed").alias("wind_speed"), *sums)
    )
    return daily if farm_key(rows) else daily.withColumn("farm", F.lit(farm))
