"""Row-for-row comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return [names[at] for at in order], sorted(tuple(_cell(row[at]) for at in order) for row in rows)


_SAME = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def differences(df, con, sql) -> list[str]:
    relation = con.sql(sql)
    names, rows = sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    want_names, want_rows = sorted_rows(relation.columns, relation.fetchall())
    found = []
    if names != want_names:
        return [f"columns {names} != {want_names}"]
    types = dict(df.dtypes)
    want_types = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    found += [f"type of {name}: {types[name]} != {want_types[name]}"
              for name in names if _SAME.get(types[name], types[name]) != want_types[name]]
    if len(rows) != len(want_rows):
        found.append(f"{len(rows)} rows != {len(want_rows)}")
    wrong = [(a, b) for a, b in zip(rows, want_rows) if a != b]
    if wrong:
        cells = [(name, x, y) for name, x, y in zip(names, *wrong[0]) if x != y]
        found.append(f"{len(wrong)} rows differ, first: {cells[:6]}")
    return found
