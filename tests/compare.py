"""Compare a registered query with its SQL twin: columns, rows and values."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns), key=repr) if columns else []


def difference(spark_table, sql_table) -> str | None:
    """None when equal, else a short description of the first difference."""
    left_names, left = rows_of(spark_table)
    right_names, right = rows_of(sql_table)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            return f"{a!r:.700}\n  !=\n{b!r:.700}"
    return None
