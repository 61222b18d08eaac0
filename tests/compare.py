"""Run a registered query and its oracle on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def _cell(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    if isinstance(value, int):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def oracle_rows(folder: str, sql: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    types = [str(c[1]) for c in result.description]
    return columns, types, result.fetchall()


def compare(spark, folder: str, function, sql: str) -> tuple[str | None, int]:
    """A description of the first difference, or None; and the number of rows."""
    frame = function(spark, folder)
    columns, types, expected = oracle_rows(folder, sql)
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}", 0
    ours = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    known = {
        "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "INTEGER": "int",
        "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
    }
    for name, kind in zip(columns, types):
        if known.get(kind, kind) != ours[name]:
            return f"type of {name}: {ours[name]} != {kind}", 0
    got = [tuple(row) for row in frame.collect()]
    left, right = normalised(frame.columns, got), normalised(columns, expected)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}", len(left)
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b}"[:600], len(left)
    return None, len(left)
