"""Order-free comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import glob
import math
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (datetime, date)):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        number = float(value)
        return None if math.isnan(number) else round(number, 6) + 0.0
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """None when equal, else a short description."""
    result = connection.execute(sql)
    expected_columns = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    have, want = bag(df.columns, df.collect()), bag(expected_columns, result.fetchall())
    if have == want:
        return None
    return (
        f"{sorted(df.columns)}\nrows {sum(have.values())} / {sum(want.values())}\n"
        f"only spark: {list((have - want).items())[:4]}\nonly sql:   {list((want - have).items())[:4]}"
    )
