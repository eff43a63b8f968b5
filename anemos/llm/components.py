"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .salts import per_salt, salt, salts_present


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _contract(near: DataFrame, smaller: bool) -> DataFrame:
    """Link the neighbours of each node (those below it, or those above) with the least node around."""
    # The hub of a large component has very many neighbours, so they are salted.
    near = near.withColumn("salt", salt("b"))
    least = near.groupBy("a").agg(F.min("b").alias("least"), salts_present().alias("salts"))
    least = per_salt(least.withColumn("least", F.least("a", "least")))
    rows = near.join(least, ["a", "salt"])
    if smaller:
        rows = rows.select(F.col("b").alias("node"), "least").unionByName(rows.select(F.col("a").alias("node"), "least"))
    else:
        rows = rows.where("b > a").select(F.col("b").alias("node"), "least")
    return rows.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """node and root, the least node it is connected with, of every node in ``links`` (a, b; numbers).

    Each round turns the links around a node towards the least node near it, and writes
    the links, so that lineage stays short; it ends when a round changes nothing.
    Nothing but a count and a sum goes to the driver. Nulls are not nodes; loops and
    repeated links change nothing; no links give no rows.
    """
    links = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    seen = None
    while True:
        larger = _contract(_both_ways(links), smaller=False)
        links = materialize(_contract(larger.where("a > b"), smaller=True), label)
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = mark
