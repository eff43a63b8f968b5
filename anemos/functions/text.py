"""Numbers and times as CSV text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

RFC3339 = "yyyy-MM-dd'T'HH:mm:ssXXX"

# The parts a configured time layout is made of, and the pattern
# letters Spark uses for the same part.
LAYOUT_PARTS = {
    "2006": "yyyy",
    "January": "MMMM",
    "Monday": "EEEE",
    "Z07:00": "XXX",
    "-0700": "xx",
    "Jan": "MMM",
    "Mon": "EEE",
    "MST": "zzz",
    ".000000": ".SSSSSS",
    ".000": ".SSS",
    "01": "MM",
    "02": "dd",
    "03": "hh",
    "04": "mm",
    "05": "ss",
    "06": "yy",
    "15": "HH",
    "PM": "a",
}

_PART = re.compile("|".join(re.escape(part) for part in LAYOUT_PARTS) + "|[A-Za-z]+|'")


def spark_time_pattern(layout: str) -> str:
    """``"2006-01-02 15:04"`` → ``"yyyy-MM-dd HH:mm"``; other letters stay as they are."""

    def translate(match: re.Match) -> str:
        token = match.group(0)
        if token in LAYOUT_PARTS:
            return LAYOUT_PARTS[token]
        return "''" if token == "'" else f"'{token}'"

    return _PART.sub(translate, layout)


def time_text(time: Column, layout: str | None = None) -> Column:
    """A time in the given layout, RFC 3339 by default; null → empty."""
    pattern = spark_time_pattern(layout) if layout else RFC3339
    return F.coalesce(F.date_format(time, pattern), F.lit(""))


def number_text(number: Column) -> Column:
    """A double in its shortest form: no trailing ``.0``, exponents only below
    1e-4 and from 1e21 on; null → empty."""
    size = F.abs(number)
    short = number.cast("string")
    plain = F.regexp_replace(short, r"\.0$", "")
    spelled = F.regexp_replace(number.cast("decimal(38,16)").cast("string"), r"\.?0+$", "")
    small = F.regexp_replace(number.cast("decimal(38,24)").cast("string"), r"0+$", "")
    power = F.regexp_replace(short, r"\.0E", "E")
    power = F.regexp_replace(power, r"E-(\d)$", "e-0$1")
    power = F.regexp_replace(power, r"E-(\d+)$", "e-$1")
    power = F.regexp_replace(power, r"E(\d+)$", "e+$1")
    return (
        F.when(number.isNull(), "")
        .when(F.isnan(number), "NaN")
        .when(number == float("inf"), "+Inf")
        .when(number == float("-inf"), "-Inf")
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), plain)
        .when((size >= 1e7) & (size < 1e21), spelled)
        .when((size >= 1e-4) & (size < 1e-3), small)
        .otherwise(power)
    )


def cell_text(column: Column, data_type: str, layout: str | None = None) -> Column:
    """Any column as CSV text, by its Spark type name."""
    if data_type in ("timestamp", "timestamp_ntz", "date"):
        return time_text(column, layout)
    if data_type in ("double", "float"):
        return number_text(column.cast("double"))
    return F.coalesce(column.cast("string"), F.lit(""))
