"""Exact duplicates by combining in three steps, each of which compares whole texts.

1. Each task combines the equal texts that it reads (the map side of the first
   aggregate), so a group of copies leaves a task as one row, however large it is.
2. Rows meet by (digest, salt, text). The salt comes from the id and spreads what is
   left of a large group over ``salts`` partitions.
3. The salt winners meet by digest and are combined by (digest, text).

The decision goes back to the rows by (digest, salt), without the text: step 3 has
compared the texts of a digest, so if it found one text, the digest stands for it.
Digests with several texts are joined by digest and text instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .text import keep_rows, single_spaced

SALTS = 32


def sha256(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    salts: int = SALTS, digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest (lower-case hex).

    Texts are equal if they are so after each run of white space became one space.
    ``keep_id`` is the smallest id of the group and ``kept`` tells if it is the row's own.

    A null text is an empty one. A null id never wins against another id; in a group
    whose ids are all null ``keep_id`` is null and every row is kept. Rows that repeat an
    id and its text are one document and share its decision, so they all count in
    ``group_size`` and are kept or dropped together. No rows give no rows, and other
    columns, whatever their names, are not read. ``salts`` is 2 to 62.
    """
    keyed = docs.select(F.col(id_col).alias("doc_id"), single_spaced(F.col(text_col)).alias("body"))
    keyed = keyed.select(
        "doc_id", "body", digest(F.col("body")).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    )
    salted = keyed.groupBy("digest", "salt", "body").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
    )
    winners = salted.repartition("digest").groupBy("digest", "body").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
        F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salt_bits"),
    )
    classes = materialize(
        winners.select(
            "digest", "keep_id", "group_size", "salt_bits",
            F.count(F.lit(1)).over(Window.partitionBy("digest")).alias("texts"),
        ),
        "exact-dedup",
    )
    present = F.filter(
        F.sequence(F.lit(0), F.lit(salts - 1)),
        lambda salt: F.call_function("shiftright", F.col("salt_bits"), salt).bitwiseAND(F.lit(1)) == 1,
    )
    single = classes.where("texts = 1").select(
        "digest", F.explode(present).alias("salt"), "keep_id", "group_size",
    )
    decided = keyed.select("doc_id", "digest", "salt").join(single, ["digest", "salt"])
    shared = classes.where("texts > 1").select("digest").distinct()
    if not shared.isEmpty():
        decided = decided.select("digest", "salt", "doc_id", "keep_id", "group_size").unionByName(
            _by_text(keyed, shared),
        )
    return decided.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("digest"),
    )


def _by_text(keyed: DataFrame, shared: DataFrame) -> DataFrame:
    """Decisions for digests that stand for several texts."""
    rows = keyed.join(shared, "digest", "left_semi")
    groups = rows.groupBy("digest", "body").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
    )
    return rows.join(groups, ["digest", "body"]).select("digest", "salt", "doc_id", "keep_id", "group_size")


def drop_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, with all their columns.

    A row stays if ``kept`` says so of its id and text together, so two texts under one id, or under null ids, are judged
    each by its own group. Rows that repeat an id and its text stay or go together.
    """
    id_col, text_col, digest = options.get("id_col", "doc_id"), options.get("text_col", "text"), options.get("digest", sha256)
    groups = duplicate_groups(docs, **options).where("kept").select("doc_id", F.unhex("digest"))
    return keep_rows(docs, groups, id_col, digest(single_spaced(F.col(text_col))))
