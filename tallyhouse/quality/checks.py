"""Counting checks on one table, batched so that a suite reads the table once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.violations import orphan_count, outside
from tallyhouse.sources.raw import union_all


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Unique:
    """Rows beyond the distinct values; NULLs have no value, so they count as excess."""

    column: str


@dataclass(frozen=True)
class InRange:
    """Inclusive bounds; NULL passes, and so does everything without bounds."""

    column: str
    min_value: float | None = None
    max_value: float | None = None


@dataclass(frozen=True)
class References:
    """Non-NULL keys that the parent lacks."""

    column: str
    parent: DataFrame
    parent_column: str


Check = NotNull | Unique | InRange | References

# what a check of each kind reports; the others leave it NULL
RESULT = {
    "check_type": "string",
    "column_name": "string",
    "total_rows": "bigint",
    "non_null_rows": "bigint",
    "null_rows": "bigint",
    "null_percentage": "double",
    "unique_values": "bigint",
    "duplicate_rows": "bigint",
    "min_value": "double",
    "max_value": "double",
    "out_of_range_rows": "bigint",
    "orphaned_rows": "bigint",
    "failed_rows": "bigint",
    "status": "string",
}


def _row(check_type: str, column: str, failed: str, **values: str) -> str:
    """One check result as a struct expression of the common shape."""
    status = f"CASE WHEN {failed} = 0 THEN 'PASS' ELSE 'FAIL' END"
    named = {"status": status, **values, "check_type": f"'{check_type}'", "column_name": f"'{column}'", "failed_rows": failed}
    return "struct(" + ", ".join(f"CAST({named.get(f, 'NULL')} AS {kind}) AS {f}" for f, kind in RESULT.items()) + ")"


def _results(totals: DataFrame, rows: list[str]) -> DataFrame:
    """The one row of totals as one row per check."""
    return totals.selectExpr(f"inline(array({', '.join(rows)}))")


def _not_null(column: str) -> str:
    present = f"`present_{column}`"
    return _row(
        "not_null",
        column,
        f"(n - {present})",
        total_rows="n",
        non_null_rows=present,
        null_rows=f"n - {present}",
        null_percentage=f"round(CAST((n - {present}) * 100 AS DECIMAL(25, 4)) / nullif(n, 0), 2)",
        # no rows means no percentage: that is an error, not a pass
        status=f"CASE WHEN n = 0 THEN 'ERROR' WHEN n = {present} THEN 'PASS' ELSE 'FAIL' END",
    )


def _distinct_pass(df: DataFrame, column: str, and_not_null: bool) -> DataFrame:
    """A distinct count on its own: it shuffles nothing but the column.

    Beside other aggregates it would drag all their buffers through the shuffle,
    once per distinct value. The same pass knows how many values are NULL.
    """
    values = df.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    totals = values.selectExpr(
        "coalesce(sum(c), 0) AS n",
        "count(v) AS d",
        f"coalesce(sum(CASE WHEN v IS NOT NULL THEN c END), 0) AS `present_{column}`",
    )
    rows = [_row("unique", column, "(n - d)", total_rows="n", unique_values="d", duplicate_rows="n - d")]
    return _results(totals, rows + [_not_null(column)] if and_not_null else rows)


def _references_pass(df: DataFrame, check: References) -> DataFrame:
    totals = orphan_count(df, check.column, check.parent, check.parent_column)
    row = _row("referential_integrity", check.column, "orphaned_rows", orphaned_rows="orphaned_rows")
    return _results(totals, [row])


def run_suite(df: DataFrame, checks: list[Check], layer: str, table: str) -> DataFrame:
    """One row per check. NULL and range checks share one pass without a shuffle."""
    for check in checks:
        if not isinstance(check, (NotNull, Unique, InRange, References)):
            raise TypeError(f"unknown check: {check!r}")
    not_null = {c.column for c in checks if isinstance(c, NotNull)}
    unique = [c for c in checks if isinstance(c, Unique)]
    present = sorted(not_null - {c.column for c in unique})
    ranges = {f"bad_{i}": c for i, c in enumerate(c for c in checks if isinstance(c, InRange))}
    parts = [_distinct_pass(df, c.column, c.column in not_null) for c in unique]
    if present or ranges:
        sums = df.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count(c).alias(f"present_{c}") for c in present],
            *[F.count_if(outside(c.column, c.min_value, c.max_value)).alias(name) for name, c in ranges.items()],
        )
        rows = [_not_null(c) for c in present]
        for name, c in ranges.items():
            low, high = ("NULL" if x is None else str(x) for x in (c.min_value, c.max_value))
            rows.append(
                _row("range", c.column, name, total_rows="n", out_of_range_rows=name, min_value=low, max_value=high)
            )
        parts.append(_results(sums, rows))
    parts += [_references_pass(df, c) for c in checks if isinstance(c, References)]
    return union_all(parts).select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "*")


def suite_totals(results: DataFrame, *by: str) -> DataFrame:
    """Passed and failed checks; an error counts as failed."""
    passed = F.col("status") == "PASS"
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(passed).alias("passed_checks"),
        F.count_if(~passed).alias("failed_checks"),
    )
