"""CSV layouts and writers.

A layout turns every column into text under its display title; writing it is
plain ``write.csv``. Output is a folder of part files, each with the header.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cell_text
from ..operators.events import check_columns

BYTE_ORDER_MARK = "\ufeff"
# Quotes are doubled and spaces kept; empty cells stay empty.
_FORMAT = {
    "header": True, "emptyValue": "", "nullValue": "", "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
_LEADING = ("Time", "DeviceName")


def report_layout(rows: DataFrame, titles: Mapping[str, str]) -> DataFrame:
    """Report rows as text: time, device, then the other titled columns by name.

    Columns without a title are left out, titled columns without data are empty.
    """
    order = [name for name in _LEADING if name in titles]
    order += sorted(name for name in titles if name not in order)
    return _as_text(rows, [(name, titles[name], None) for name in order])


def event_layout(events: DataFrame, columns: Sequence[Mapping[str, str]]) -> DataFrame:
    """Events as text in the configured columns (field, title, time_format).

    The first title starts with a byte-order mark, which spreadsheets need to
    read the titles as UTF-8.
    """
    check_columns(columns)
    chosen = [(c["field"], c["title"], c.get("time_format") or None) for c in columns]
    if chosen:
        name, title, layout = chosen[0]
        chosen[0] = (name, BYTE_ORDER_MARK + title, layout)
    return _as_text(events, chosen)


def _as_text(df: DataFrame, columns: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    types = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    return df.select(*[
        (cell_text(F.col(name), types[name], layout) if name in types else F.lit("")).alias(title)
        for name, title, layout in columns
    ])


def write_layout(layout: DataFrame, path: str) -> None:
    """Write text rows as CSV with a header."""
    layout.write.mode("overwrite").csv(path, **_FORMAT)


def write_resampled(df: DataFrame, path: str, per_device: bool = False) -> None:
    """Resampled signals as CSV: one folder, or one folder per turbine."""
    writer = df.write
    if per_device:
        writer = df.withColumn("device", F.col("turbine")).hint("rebalance", "device").write.partitionBy("device")
    writer.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path, **_FORMAT)


def write_reports(rows: DataFrame, titles: Mapping[str, str], path: str, merge: bool = True) -> None:
    """Report rows as CSV: one folder for all groups, or one folder per group.

    Every group is written by the tasks that hold its rows; nothing is gathered.
    """
    if merge:
        write_layout(report_layout(rows, titles), path)
        return
    layout = report_layout(rows.withColumn("_group", F.col("DeviceName")), {**titles, "_group": "group"})
    layout.write.mode("overwrite").partitionBy("group").csv(path, **_FORMAT)
