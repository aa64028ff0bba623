"""Running a generic test with its modifiers, and grading what it found."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Test:
    """A named rule: a query of violations, and how to count and judge them.

    ``violations`` takes the tested table, already filtered by ``where``.
    Thresholds are comparisons with the number of failures, such as ``">10"``.
    """

    __test__ = False

    name: str
    violations: Callable[[DataFrame], DataFrame]
    where: str | None = None
    severity: str = "error"
    warn_if: str = "!= 0"
    error_if: str = "!= 0"
    fail_calc: Callable[[], Column] = field(default=lambda: F.count(F.lit(1)))

    def __post_init__(self) -> None:
        if self.severity not in ("error", "warn"):
            raise ValueError(f"severity must be 'error' or 'warn', got {self.severity!r}")

    def failing_rows(self, df: DataFrame) -> DataFrame:
        return self.violations(df.filter(self.where) if self.where else df)

    def failures(self, df: DataFrame) -> DataFrame:
        """One row with the number of failures."""
        found = self.failing_rows(df).agg(F.coalesce(self.fail_calc(), F.lit(0)).cast("bigint").alias("failures"))
        return found.select(F.lit(self.name).alias("test"), "failures", self.status(F.col("failures")).alias("status"))

    def status(self, failures: Column) -> Column:
        return grade(failures, self.severity, self.warn_if, self.error_if)


def grade(failures: Column, severity: str = "error", warn_if: str = "!= 0", error_if: str = "!= 0") -> Column:
    """pass, warn or error. With severity ``warn`` the error threshold is not looked at."""

    def holds(threshold: str) -> Column:
        limit = F.lit(int(threshold.lstrip("<>!= ")))
        return {
            "<": failures < limit,
            "<=": failures <= limit,
            ">": failures > limit,
            ">=": failures >= limit,
            "=": failures == limit,
            "==": failures == limit,
            "!=": failures != limit,
            "<>": failures != limit,
        }[threshold.rstrip("0123456789 ").strip()]

    verdict = F.when(holds(warn_if), "warn").otherwise("pass")
    return F.when(holds(error_if), "error").otherwise(verdict) if severity == "error" else verdict


def store_failures(tests: list[Test], df: DataFrame, root: str) -> dict[str, str]:
    """Write the violations of every test to its own table below ``root``; returns their paths."""
    paths = {}
    for test in tests:
        paths[test.name] = f"{root}/{test.name}"
        test.failing_rows(df).write.mode("overwrite").parquet(paths[test.name])
    return paths
