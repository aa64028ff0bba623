"""DQ: counting checks, suites and the layer report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.warehouse import LAYERS
from tallyhouse.quality.checks import InRange, NotNull, References, Unique, run_suite, suite_totals
from tallyhouse.quality.report import STAGING_CHECKS, quality_report
from tallyhouse.registry import query
from tallyhouse.registry.common import staged, warehouse
from tallyhouse.registry.sqltext import rounded, sql
from tallyhouse.sources.tables import table

_NULLABLE = {"transaction_id": "tid", "customer_id": "cid", "quantity": "qty", "price": "price_c", "line_total": "tot_c"}


@query(
    "dq1_check_not_null",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS column_name, count(*) AS total_rows, count({c}) AS non_null_rows,
                count(*) - count({c}) AS null_rows, {rounded(f'100 * (count(*) - count({c}))', 'count(*)')} AS null_percentage,
                CASE WHEN count(*) = count({c}) THEN 'PASS' ELSE 'FAIL' END AS status FROM stg"""
            for name, c in _NULLABLE.items()
        ),
        "stg",
    ),
)
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_suite(staged(spark, sf_dir), [NotNull(c) for c in _NULLABLE], "staging", "stg_transactions").select(
        "column_name", "total_rows", "non_null_rows", "null_rows", "null_percentage", "status"
    )


_KEYED = {"transaction_id": "tid", "customer_id": "cid", "product_id": "pid"}


@query(
    "dq2_check_unique",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS column_name, count(*) AS total_rows, count(DISTINCT {c}) AS unique_values,
                count(*) - count(DISTINCT {c}) AS duplicate_rows,
                CASE WHEN count(*) = count(DISTINCT {c}) THEN 'PASS' ELSE 'FAIL' END AS status FROM stg"""
            for name, c in _KEYED.items()
        ),
        "stg",
    ),
)
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_suite(staged(spark, sf_dir), [Unique(c) for c in _KEYED], "staging", "stg_transactions").select(
        "column_name", "total_rows", "unique_values", "duplicate_rows", "status"
    )


@query(
    "dq3_check_range",
    sql(
        """SELECT 'price' AS column_name, CAST(60 AS DOUBLE) AS min_value, CAST(200 AS DOUBLE) AS max_value, count(*) AS total_rows,
                  count(CASE WHEN price_c < 6000 OR price_c > 20000 THEN 1 END) AS out_of_range_rows FROM stg
           UNION ALL SELECT 'tax', NULL, 25, count(*), count(CASE WHEN tax_c > 2500 THEN 1 END) FROM stg
           UNION ALL SELECT 'quantity', NULL, NULL, count(*), 0 FROM stg""",
        "stg",
    ),
)
def check_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [InRange("price", 60, 200), InRange("tax", max_value=25), InRange("quantity")]
    return run_suite(staged(spark, sf_dir), checks, "staging", "stg_transactions").select(
        "column_name", "min_value", "max_value", "total_rows", "out_of_range_rows"
    )


@query(
    "dq4_check_referential_integrity",
    """SELECT 'l_orderkey' AS column_name, count(*) AS orphaned_rows FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
       UNION ALL SELECT 'l_suppkey', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def check_referential_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    checks = [
        References("l_orderkey", orders, "o_orderkey"),
        References("l_suppkey", table(spark, sf_dir, "supplier"), "s_suppkey"),
    ]
    return run_suite(table(spark, sf_dir, "lineitem"), checks, "source", "lineitem").select(
        "column_name", "orphaned_rows"
    )


_STAGING_FAILURES = {
    ("not_null", "transaction_id"): "count(*) - count(tid)",
    ("unique", "transaction_id"): "count(*) - count(DISTINCT tid)",
    ("not_null", "transaction_date"): "count(*) - count(day)",
    ("not_null", "product_id"): "count(*) - count(pid)",
    ("not_null", "product_name"): "count(*) - count(pname)",
    ("range", "price"): "count(CASE WHEN price_c < 0 OR price_c > 1000000 THEN 1 END)",
    ("range", "quantity"): "count(CASE WHEN qty < 0 OR qty > 100 THEN 1 END)",
    ("range", "tax"): "count(CASE WHEN tax_c < 0 OR tax_c > 100000 THEN 1 END)",
    ("range", "line_subtotal"): "count(CASE WHEN sub_c < 0 THEN 1 END)",
    ("range", "line_total"): "count(CASE WHEN tot_c < 0 THEN 1 END)",
}
_FACT_FAILURES = {
    ("not_null", "transaction_id"): "count(*) - count(transaction_id)",
    ("unique", "transaction_id"): "count(*) - count(DISTINCT transaction_id)",
    ("not_null", "customer_key"): "count(*) - count(customer_key)",
    ("not_null", "product_key"): "count(*) - count(product_key)",
    ("not_null", "date_key"): "count(*) - count(date_key)",
    ("range", "quantity"): "count(CASE WHEN quantity < 0 THEN 1 END)",
    ("range", "unit_price"): "count(CASE WHEN price_c < 0 THEN 1 END)",
    ("range", "line_total"): "count(CASE WHEN tot_c < 0 THEN 1 END)",
    ("range", "data_quality_score"): "count(CASE WHEN data_quality_score < 0 OR data_quality_score > 7 THEN 1 END)",
}


def _suite_sql(layer: str, name: str, failures: dict, source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{layer}' AS layer, '{name}' AS table_name, '{kind}' AS check_type, '{column}' AS column_name,
            count(*) AS total_rows, {failed} AS failed_rows,
            CASE WHEN {failed} = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {source}"""
        for (kind, column), failed in failures.items()
    )


@query(
    "dq5_quality_suite",
    sql(
        f"""SELECT layer, table_name, count(*) AS total_checks, count(CASE WHEN status = 'PASS' THEN 1 END) AS passed_checks,
            count(CASE WHEN status <> 'PASS' THEN 1 END) AS failed_checks
            FROM ({_suite_sql('staging', 'stg_transactions', _STAGING_FAILURES, 'stg')}
                  UNION ALL SELECT 'source', 'lineitem', 'unique', 'l_orderkey', count(*),
                            count(*) - count(DISTINCT l_orderkey), 'FAIL' FROM lineitem
                  UNION ALL SELECT 'source', 'lineitem', 'range', 'l_quantity', count(*), 0, 'PASS' FROM lineitem)
            GROUP BY layer, table_name""",
        "stg",
    ),
)
def quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = run_suite(staged(spark, sf_dir), STAGING_CHECKS, "staging", "stg_transactions")
    lines = table(spark, sf_dir, "lineitem")
    source = run_suite(lines, [Unique("l_orderkey"), InRange("l_quantity", 0, 1000)], "source", "lineitem")
    return suite_totals(stg.unionByName(source), "layer", "table_name")


def _key_failures(key: str) -> dict:
    return {
        ("not_null", key): f"count(*) - count({key})",
        ("unique", key): f"count(*) - count(DISTINCT {key})",
    }


@query(
    "dq6_layer_report",
    sql(
        " UNION ALL ".join(
            [
                _suite_sql("staging", "stg_transactions", _STAGING_FAILURES, "stg"),
                _suite_sql("mart", "fact_transactions", _FACT_FAILURES, "fact"),
                _suite_sql("mart", "dim_customers", _key_failures("customer_id"), "dim_customers"),
                _suite_sql("mart", "dim_products", _key_failures("product_id"), "dim_products"),
                _suite_sql("mart", "dim_dates", _key_failures("date_day"), "calendar"),
                """SELECT 'raw', 'customer_transactions', 'row_count', NULL, count(*),
                   CAST(count(*) = 0 AS BIGINT), CASE WHEN count(*) = 0 THEN 'FAIL' ELSE 'PASS' END FROM raw""",
            ]
        ),
        "fact", "dim_customers", "dim_products", "calendar",
    ),
)
def layer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = warehouse(spark, sf_dir)
    layers = dict.fromkeys(LAYERS.values())
    report = quality_report({name: df for layer in layers for name, df in tables.build_layer(layer).items()})
    return report.select("layer", "table_name", "check_type", "column_name", "total_rows", "failed_rows", "status")
