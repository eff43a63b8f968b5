"""A mix of sources at target weights, by a low-discrepancy schedule of blocks.

Every source's documents stand in a shuffled row (in the order of a seeded hash) and
are cut into blocks of equal tokens, which the mix takes from the front, starting
again at the end. Slot k of the mix belongs to the source on whose stretch of the
cumulative weights the golden-ratio point frac(k * phi) falls, and the slot's rank
among the slots of its source says which block it takes. So every run of slots, long
or short, has close to the target shares.

All blocks are of one length, so a source gives as many words as it got slots times that. The points are so
even that this is its target but for a few blocks; there are at least ``SLOTS`` slots if the words suffice, so a
few blocks are little. Only what would repeat a source more often than allowed is left out.
Ranks and places are prefix sums over pieces of the schedule and over hash ranges, so
a source that holds most of the rows is not one task's work. What is gathered in one
place has one row per source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, small_table
from .text import BREAKS, whole, words

# The longest and the shortest block, and the slots that a mix has at least in between.
BLOCK, SHORT_BLOCK, SLOTS = 1024, 4, 1 << 18
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
PIECE = 1 << 16
# Documents in a range of the shuffle, about.
RANGE_ROWS = 50_000
WIDTH = 1 << 31
STEP = int((math.sqrt(5) - 1) / 2 * WIDTH) | 1


def word_count(text: Column) -> Column:
    """Words of a text: each becomes one character, then white space goes."""
    marks = F.regexp_replace(whole(text), "[^\\x20\\x09-\\x0D]+", "x")
    return F.length(F.translate(marks, " " + BREAKS, "")).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> list[dict]:
    """Per source, in code-point order and null last: source, size, weight, target.

    Targets share the sum of all sizes by weight; one above ``max_repeat`` times its
    source's size stops there and the rest is shared again among the others.
    """
    found = sizes.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found.sort(key=lambda row: (row["source"] is None, (row["source"] or "").encode("utf-8")))
    sources = [{"source": row["source"], "size": row["size"], "weight": weights[at % len(weights)]}
               for at, row in enumerate(found)]
    left, open_ = float(sum(s["size"] for s in sources)), list(sources)
    while open_:
        unit = left / sum(s["weight"] for s in open_)
        full = [s for s in open_ if s["weight"] * unit > max_repeat * s["size"]]
        if not full:
            for s in open_:
                s["target"] = s["weight"] * unit
            break
        for s in full:
            s["target"] = float(max_repeat * s["size"])
            left -= s["target"]
        open_ = [s for s in open_ if "target" not in s]
    return sources


def block_length(sources: list[dict]) -> int:
    """Words of a block: as many as leave ``SLOTS`` slots, between the shortest and the longest."""
    return min(max(sum(math.floor(s["target"]) for s in sources) // SLOTS, SHORT_BLOCK), BLOCK)


def schedule(spark, sources: list[dict], block: int = BLOCK) -> DataFrame:
    """slot, at (index of the source), rank: which source fills each slot, and with which of its blocks.

    A source whose stretch no point hits gets one slot behind the others.
    """
    total = sum(math.floor(s["target"]) for s in sources)
    slots = -(-total // block)
    edges, sum_ = [], 0
    for s in sources:
        sum_ += math.floor(s["target"])
        edges.append(sum_ / total if total else 1.0)
    # The point of slot k, in whole numbers: an odd step visits every place before it repeats.
    bounds = F.array(*[F.lit(round(edge * WIDTH)).cast("long") for edge in edges])
    point = F.pmod(F.pmod(F.col("slot"), F.lit(WIDTH)) * F.lit(STEP), F.lit(WIDTH))
    at = F.size(F.filter(bounds, lambda bound: bound <= point))
    drawn = spark.range(slots).withColumnRenamed("id", "slot").withColumn("at", F.least(at, F.lit(len(sources) - 1)))
    drawn = drawn.withColumn("piece", F.call_function("div", F.col("slot"), F.lit(PIECE).cast("long")))
    ahead = Window.partitionBy("at").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = drawn.groupBy("at", "piece").count().select(
        "at", "piece", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before"))
    within = Window.partitionBy("at", "piece").orderBy("slot")
    return drawn.join(before, ["at", "piece"]).select(
        "slot", "at", (F.col("before") + F.row_number().over(within) - 1).alias("rank"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT,
        block: int | None = None, seed: int = 0, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix and the sized documents.

    The mix has a row per piece of a document that a slot takes: slot, row, doc_id,
    pass_, first and n (words ``first`` to ``first + n - 1`` of the text, in the given pass
    over its source). The documents have row (a number that tells rows apart: ``row_col`` if
    given), doc_id, source, size in words, source_size and target. Per source, the words
    taken are those of its slots; ``block`` is the length of one (:func:`block_length` if not given).

    Null sources are one source, which comes last; null texts are empty and take no
    place. Repeated rows and ids are documents of their own. No documents, or only empty
    ones, give an empty mix. Other columns are not read.
    """
    spark = docs.sparkSession
    number = F.col(row_col) if row_col else F.monotonically_increasing_id()
    sized = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"), number.alias("row"))
    sized = materialize(sized, "mixing")
    sources = source_targets(sized, weights, max_repeat)
    block = block or block_length(sources)
    slots = materialize(schedule(spark, sources, block), "mixing-slots")
    per_source = {row["at"]: row["count"] for row in slots.groupBy("at").count().collect()}
    missed = [at for at, s in enumerate(sources) if s["target"] >= 1 and at not in per_source]
    last = sum(per_source.values())
    slots = slots.unionByName(small_table(
        spark, [(last + i, at, 0) for i, at in enumerate(missed)], "slot bigint, at int, rank bigint"))
    # A source that no point hit gives its one block, but no more than its target.
    wanted = [min(per_source[at] * block, max_repeat * s["size"]) if at in per_source else min(block, math.floor(s["target"]))
              for at, s in enumerate(sources)]
    listed = small_table(
        spark, [(at, s["source"], s["size"], float(s["target"]), wanted[at]) for at, s in enumerate(sources)],
        "at int, _source string, source_size bigint, target double, wanted bigint")
    bits = max(4, (sized.count() // RANGE_ROWS).bit_length())
    sized = sized.join(listed, F.col("source").eqNullSafe(F.col("_source")))

    # Where each document stands in its source's row.
    rows = sized.where("size > 0 and wanted > 0")
    rows = rows.withColumn("range", F.shiftrightunsigned("key", 64 - bits))
    ahead = Window.partitionBy("at").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("at", "range").agg(F.sum("size").alias("n")).select(
        "at", "range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    within = Window.partitionBy("at", "range").orderBy("key", "doc_id", "size", "row")
    start = F.col("offset") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = rows.join(ranges, ["at", "range"]).withColumn("start", start).where("start < wanted")

    # Each pass over the source, and the blocks a document reaches into.
    passes = F.sequence(F.lit(0).cast("long"), F.expr("(wanted - start - 1) div source_size"))
    taken = placed.withColumn("pass_", F.explode(passes)).withColumn("from_", F.expr("pass_ * source_size + start"))
    taken = taken.withColumn("to_", F.expr("least(from_ + size, wanted)"))
    reached = F.sequence(F.expr(f"from_ div {block}"), F.expr(f"(to_ - 1) div {block}"))
    pieces = taken.withColumn("rank", F.explode(reached)).withColumns({
        "begin": F.expr(f"greatest(from_, rank * {block})"), "end": F.expr(f"least(to_, (rank + 1) * {block})")})
    pieces = pieces.select(
        "at", "rank", "row", "doc_id", "pass_", F.expr("begin - from_").alias("first"), F.expr("end - begin").alias("n"))
    mixed = slots.join(pieces, ["at", "rank"]).select("slot", "row", "doc_id", "pass_", "first", "n")
    return mixed, sized.select("row", "doc_id", "source", "size", "source_size", "target")


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's) and taken, the words the mix takes of it."""
    mixed, sized = mix(docs, **options)
    taken = mixed.groupBy("row").agg(F.sum("n").alias("taken"))
    return sized.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, with their columns: one row per pass that takes one, in the order of the first slot
    that takes of it (over and within the partitions).

    A pass that ends within a document takes its first words, joined by single spaces;
    ``n_chars``, if there is one, is then counted anew. Documents without words, as null texts are, take no slot and are
    not in the mix. Null and repeated ids and repeated rows are documents of their own. No documents give no rows. Columns
    of any name go through as they are.
    """
    number = "_mix_row"
    while number in docs.columns:
        number += "_"
    numbered = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "mixing-documents")
    mixed, sized = mix(numbered, row_col=number, **options)
    copies = mixed.groupBy("row", "pass_").agg(F.sum("n").alias("_taken_words"), F.min("slot").alias("_first_slot"))
    copies = copies.join(sized.select("row", F.col("size").alias("_all_words")), "row")
    rows = numbered.join(copies.withColumnRenamed("row", "_copy_row"), F.col(number) == F.col("_copy_row"))
    rows = rows.repartitionByRange("_first_slot", number).sortWithinPartitions("_first_slot", number)
    cut = F.col("_taken_words") < F.col("_all_words")
    first = F.array_join(F.slice(words(F.col("text")), F.lit(1), F.col("_taken_words").cast("int")), " ")
    rows = rows.withColumn("text", F.when(cut, first).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn(
            "n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
