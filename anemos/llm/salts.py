"""Joins of many rows to one row per key, where one key may hold a third of all rows.

The many rows get a salt from a column of their own. The one row of a key collects which salts
its key has, in one number, and is repeated once for each of them; keys with few rows have few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32


def salt(key: Column | str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")


def salts_present(salt_column: str = "salt") -> Column:
    """Aggregate: a bit for each salt."""
    return F.bit_or(F.expr(f"shiftleft(1L, `{salt_column}`)"))


def per_salt(rows: DataFrame, bits: str = "salts", name: str = "salt") -> DataFrame:
    """Each row once per salt that its bits name."""
    present = F.filter(
        F.sequence(F.lit(0), F.lit(SALTS - 1)),
        lambda at: F.call_function("shiftright", F.col(bits), at).bitwiseAND(F.lit(1)) == 1)
    return rows.select(F.explode(present).alias(name), "*").drop(bits)
