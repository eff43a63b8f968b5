"""Column expressions over whole texts that several operators share.

White space is the six characters of ``[\\x20\\x09-\\x0D]`` throughout; a word is a
run of anything else. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAKS = "\t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once although ``body`` may use it often.

    Higher-order functions evaluate what they refer to anew for each element; a lambda
    variable is bound to the value instead.
    """
    return F.transform(F.array(value), body)[0]


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def single_spaced(text: Column) -> Column:
    """The text with every run of white space replaced by one space."""
    return F.regexp_replace(whole(text), "[\\x20\\x09-\\x0D]+", " ")


def words(text: Column) -> Column:
    """All words of a text, in order."""
    spaced = F.translate(whole(text), BREAKS, " " * len(BREAKS))
    return F.filter(F.split(spaced, " "), lambda word: word != "")


def word_chars(text: Column) -> Column:
    """Code points outside white space."""
    return F.length(F.translate(whole(text), " " + BREAKS, "")).cast("long")


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, key: Column) -> DataFrame:
    """The rows of ``docs`` whose id and key ``kept`` (two columns) has. The key of a row is computed once."""
    name = "_row_key"
    while name in docs.columns:
        name += "_"
    keyed = docs.withColumn(name, key)
    kept = kept.toDF("_kept_id", "_kept_key").distinct()
    same = keyed[id_col].eqNullSafe(kept["_kept_id"]) & (keyed[name] == kept["_kept_key"])
    return keyed.join(kept, same, "left_semi").select(*[F.col(f"`{column}`") for column in docs.columns])


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(whole(text)).cast("long")
