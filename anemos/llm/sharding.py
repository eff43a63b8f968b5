"""Shards by a keyed permutation of global row numbers.

Rows are numbered 0 to n - 1 in the order of a hash of their content. A Feistel
network over the grid of ceil(sqrt n) by as many columns as n needs permutes the
numbers; one that falls outside is permuted again until it is inside (cycle walking,
needed for less than one cell in sqrt n). The place p of a row is then shard p mod k,
slot p div k: shards differ by one row at most, and shard and slot of any row number
can be computed, or undone, without looking at other rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, small_table
from .text import utf8_bytes

BUCKET_BITS = 12
ROUNDS = 6
WALK = 64


def numbered(rows: DataFrame, key: str, number: str = "row_number") -> tuple[DataFrame, int]:
    """Rows with numbers from 0 without gaps, in the order of ``key``, a hash, and how many there are.

    The top bits of the hash cut the rows into 4096 runs that follow one another. The
    lengths of the runs are all that the driver sees. Rows with equal hashes are put in
    order of all columns, so the numbers depend on nothing but the data. ``rows`` is
    read twice: pass a table.
    """
    run = F.shiftrightunsigned(F.col(key), 64 - BUCKET_BITS).cast("int")
    rows = rows.withColumn("_run", run)
    lengths = {found["_run"]: found["count"] for found in rows.groupBy("_run").count().collect()}
    starts, total = [], 0
    for at in sorted(lengths):
        starts.append((at, total))
        total += lengths[at]
    starts = small_table(rows.sparkSession, starts, "_run int, _start bigint")
    order = Window.partitionBy("_run").orderBy(key, *[name for name in rows.columns if name not in (key, "_run")])
    place = F.row_number().over(order) - 1 + F.col("_start")
    return rows.join(starts, "_run").withColumn(number, place).drop("_run", "_start"), total


def _mix(value: Column, key: Column, seed: int, size: int) -> Column:
    return F.pmod(F.xxhash64(value, key, F.lit(seed)), F.lit(size).cast("long"))


def permuted(number: Column, n: int, seed: int = 0, rounds: int = ROUNDS) -> Column:
    """The place of ``number`` in a permutation of 0 to n - 1 that ``seed`` chooses."""
    high = max(1, math.isqrt(max(n - 1, 0)) + 1)
    low = max(1, -(-n // high))

    def turn(pair: Column, at: Column) -> Column:
        left, right = pair["l"], pair["r"]
        even = F.pmod(left + _mix(right, at, seed, high), F.lit(high).cast("long"))
        odd = F.pmod(right + _mix(left, at, seed, low), F.lit(low).cast("long"))
        return F.when(at % 2 == 0, F.struct(even.alias("l"), right.alias("r"))).otherwise(
            F.struct(left.alias("l"), odd.alias("r")))

    def once(value: Column) -> Column:
        start = F.struct(
            F.call_function("div", value, F.lit(low).cast("long")).cast("long").alias("l"),
            F.pmod(value, F.lit(low).cast("long")).alias("r"),
        )
        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn, lambda pair: pair["l"] * F.lit(low).cast("long") + pair["r"])

    inside = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), once(number.cast("long")),
        lambda value, _: F.when(value < n, value).otherwise(once(value)),
    )
    return F.when(inside < n, inside).otherwise(F.raise_error(F.lit("the walk left the grid")).cast("long"))


def shard_rows(rows: DataFrame, shards: int, key: str = "row_key", seed: int = 0) -> DataFrame:
    """``rows`` with row_number, shard and slot.

    ``key`` is a column of 64-bit hashes of what tells rows apart; it may hold nulls
    (they count as 0) and repeated values, rows that are equal throughout get a place each. No rows
    give no rows; with fewer rows than shards some shards are empty.
    """
    rows = rows.withColumn(key, F.coalesce(F.col(key), F.lit(0).cast("long")))
    placed, n = numbered(rows, key)
    placed = placed.withColumn("_place", permuted(F.col("row_number"), n, seed))
    return placed.withColumns({
        "shard": F.pmod("_place", F.lit(shards)).cast("int"),
        "slot": F.call_function("div", F.col("_place"), F.lit(shards).cast("long")).cast("long"),
    }).drop("_place")


def shard_documents(docs: DataFrame, shards: int = 40, overhead: int = 16, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard and slot of every document.

    Size is the text in UTF-8 plus ``overhead``. Null texts are empty, null and repeated
    ids are rows like any other, and further columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (utf8_bytes(F.col("text")) + overhead).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id", "text").alias("row_key"),
    )
    return shard_rows(materialize(rows, "sharding"), shards, "row_key", seed).drop("row_key")
