"""The quality report over all layers, and the gate that stops a bad run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.arithmetic import percentage
from tallyhouse.quality.checks import Check, InRange, NotNull, Unique, run_suite, suite_totals
from tallyhouse.sources.raw import union_all

# The checks of each layer and their bounds.
STAGING_CHECKS: list[Check] = [
    NotNull("transaction_id"),
    Unique("transaction_id"),
    NotNull("transaction_date"),
    NotNull("product_id"),
    NotNull("product_name"),
    InRange("price", 0, 10000),
    InRange("quantity", 0, 100),
    InRange("tax", 0, 1000),
    InRange("line_subtotal", 0),
    InRange("line_total", 0),
]
FACT_CHECKS: list[Check] = [
    NotNull("transaction_id"),
    Unique("transaction_id"),
    NotNull("customer_key"),
    NotNull("product_key"),
    NotNull("date_key"),
    InRange("quantity", 0),
    InRange("unit_price", 0),
    InRange("line_total", 0),
    InRange("data_quality_score", 0, 7),
]
DIMENSION_KEYS = {"dim_customers": "customer_id", "dim_products": "product_id", "dim_dates": "date_day"}


class QualityError(ValueError):
    """At least one check failed."""


def raw_check(raw: DataFrame) -> DataFrame:
    """The raw layer holds rows. An empty layer fails the run."""
    empty = F.when(F.col("n") == 0, 1).otherwise(0).cast("bigint")
    return raw.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("raw").alias("layer"),
        F.lit("customer_transactions").alias("table_name"),
        F.lit("row_count").alias("check_type"),
        F.col("n").alias("total_rows"),
        empty.alias("failed_rows"),
        F.when(F.col("n") == 0, "FAIL").otherwise("PASS").alias("status"),
    )


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Every check of every layer, one row each."""
    suites = [
        run_suite(tables["stg_transactions"], STAGING_CHECKS, "staging", "stg_transactions"),
        run_suite(tables["fact_transactions"], FACT_CHECKS, "mart", "fact_transactions"),
    ]
    for name, key in DIMENSION_KEYS.items():
        suites.append(run_suite(tables[name], [NotNull(key), Unique(key)], "mart", name))
    checks = union_all(suites)
    return checks.unionByName(raw_check(tables["customer_transactions"]), allowMissingColumns=True)


def report_summary(report: DataFrame) -> DataFrame:
    """Totals and pass rate. The raw layer's row count is a precondition, not a check."""
    return suite_totals(report.filter("layer <> 'raw'")).withColumn(
        "pass_rate", percentage(F.col("passed_checks"), F.col("total_checks")).cast("double")
    )


def gate(report: DataFrame) -> dict:
    """The summary, or an error naming what failed."""
    failed = report.filter("status <> 'PASS'").select("table_name", "check_type", "column_name", "failed_rows").collect()
    if failed:
        names = [f"{r.table_name}.{r.column_name} {r.check_type}: {r.failed_rows}" for r in failed]
        raise QualityError(f"{len(failed)} checks failed: {names}")
    return report_summary(report).first().asDict()
