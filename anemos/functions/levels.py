"""Event levels and flags as text, and levels back from text or number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that stand for event levels and flags.
LEVEL_TEXT = {1: "提示", 2: "告警", 3: "预警", 4: "故障"}
FIRST_TEXT = {True: "是", False: "否"}
CONFIRMED_TEXT = {True: "已确认", False: "未确认"}


def level_text(level: Column) -> Column:
    """Level number → text; unknown levels have no text."""
    result = F.lit("")
    for number, text in LEVEL_TEXT.items():
        result = F.when(level == number, text).otherwise(result)
    return result


def level_number(value: Column) -> Column:
    """Level text or number text → level number; anything else is 0."""
    value = value.cast("string")
    result = F.lit(0)
    for number, text in LEVEL_TEXT.items():
        result = F.when(value.isin(text, str(number)), number).otherwise(result)
    return result


def _flag_text(flag: Column, texts: dict[bool, str]) -> Column:
    return F.when(flag == 1, texts[True]).otherwise(texts[False])


def first_text(flag: Column) -> Column:
    return _flag_text(flag, FIRST_TEXT)


def confirmed_text(flag: Column) -> Column:
    return _flag_text(flag, CONFIRMED_TEXT)
