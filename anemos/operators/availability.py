"""Time availability: minutes per turbine, day and condition label."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .conditions import INVALID, NO_DATA, farm_key

DAY_SECONDS = 86_400


def daily_minutes(sums: DataFrame) -> DataFrame:
    """Minutes per turbine, day and label, and the rest of the day as label 1000.

    Every labelled second is counted for its label and against the rest, so one
    aggregate gives both. A day with invalid samples only is all rest.
    """
    counted = F.when((F.col("label") != INVALID) & F.col("label").isNotNull(), F.col("samples"))
    entries = F.array(
        F.struct(F.col("label").cast("int").alias("label"), counted.alias("seconds")),
        F.struct(F.lit(NO_DATA).alias("label"), (-F.coalesce(counted, F.lit(0))).alias("seconds")),
    )
    own = [*farm_key(sums), "turbine"]
    per_label = sums.groupBy(*own, F.to_date("w").alias("record_date"), "label").agg(
        F.sum("samples").alias("samples")
    )
    rest = F.when(F.col("label") == NO_DATA, DAY_SECONDS).otherwise(0)
    return (
        per_label.select(*own, "record_date", F.inline(entries))
        .where(F.col("seconds").isNotNull())
        .groupBy(*own, "record_date", "label")
        .agg(F.sum("seconds").alias("seconds"))
        .select(*own, "record_date", "label", ((F.col("seconds") + rest) / 60.0).alias("duration"))
    )


def availability_calendar(minutes: DataFrame, first: dt.date, last: dt.date, farm: str = "farm") -> DataFrame:
    """Daily minutes for every turbine with data and every day of the request.

    A day without data is 1440 minutes of label 1000 and has no month, as it was
    not measured. Days before the first measured day of the farm are cut.
    ``farm`` names the farm of minutes that have no column of that name.
    ``minutes`` is read three times: pass a table, not a plan over samples.
    """
    span = F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL '1' DAY"))
    own = [*farm_key(minutes), "turbine"]
    days = minutes.select(*own).distinct().select(*own, F.explode(span).alias("record_date"))
    measured = minutes.withColumn("record_month", F.date_format("record_date", "yyyy-MM"))
    full = days.join(measured, [*own, "record_date"], "left").select(
        "record_date",
        F.coalesce("label", F.lit(NO_DATA)).alias("label"),
        F.coalesce("duration", F.lit(DAY_SECONDS / 60.0)).alias("duration"),
        "record_month",
        "turbine",
        (F.col("farm") if "farm" in own else F.lit(farm)).alias("farm"),
    )
    known = minutes.where((F.col("label") != NO_DATA) & F.col("record_date").between(F.lit(first), F.lit(last)))
    if "farm" in own:
        starts = known.groupBy("farm").agg(F.min("record_date").alias("_start"))
        return full.join(starts, "farm").where(F.col("record_date") >= F.col("_start")).select(*full.columns)
    start = known.agg(F.min("record_date").alias("d")).select("d").scalar()
    return full.where(F.col("record_date") >= start)
