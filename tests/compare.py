"""Comparing a Spark result with the rows another engine gives for the same question."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def cell(x: object) -> object:
    """Values in one spelling per kind; doubles keep 9 significant digits."""
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, decimal.Decimal):
        raise TypeError("decimals must not reach a comparison")
    if isinstance(x, float):
        return None if math.isnan(x) else ("f", float(f"{x:.9g}"))
    if isinstance(x, (dt.date, dt.datetime)):
        raise TypeError("dates must not reach a comparison")
    return x


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Column names, kinds of value and all rows must agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns: {sorted(set(names) ^ set(spark_df.columns))}"
    expected = rows_of(names, cursor.fetchall())
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if expected == actual:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}, {sum(missing.values())} differ in {sorted(names)}\n"
        f"  expected {list(missing)[:2]}\n  actual   {list(extra)[:2]}"
    )
