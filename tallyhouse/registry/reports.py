"""BQ: verification and business queries over the built marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans import reports as R
from tallyhouse.plans.fact import QUALITY_FLAGS
from tallyhouse.plans.warehouse import LAYERS
from tallyhouse.registry import query
from tallyhouse.registry.common import comparable, mart, warehouse
from tallyhouse.registry.sqltext import money, rounded, sql


@query(
    "bq1_rows_per_layer",
    sql(
        """SELECT 'raw' AS layer, count(*) AS rows FROM raw UNION ALL SELECT 'staging', count(*) FROM stg
           UNION ALL SELECT 'fact', count(*) FROM fact UNION ALL SELECT 'dim_customers', count(*) FROM dim_customers
           UNION ALL SELECT 'dim_products', count(*) FROM dim_products
           UNION ALL SELECT 'dim_dates', count(*) FROM calendar""",
        "fact", "dim_customers", "dim_products", "calendar",
    ),
)
def rows_per_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"customer_transactions": "raw", "stg_transactions": "staging", "fact_transactions": "fact"}
    tables = warehouse(spark, sf_dir)
    shown = [t for t in LAYERS if t not in ("monthly_customer_summary", "product_performance")]
    return R.layer_counts({names.get(t, t): tables.table(t) for t in shown})


@query(
    "bq2_score_distribution",
    sql(
        f"""SELECT data_quality_score, n AS transaction_count, {rounded('100 * n', 'total')} AS percentage
            FROM (SELECT data_quality_score, count(*) AS n FROM fact GROUP BY data_quality_score),
                 (SELECT count(*) AS total FROM fact)""",
        "fact",
    ),
)
def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(R.score_distribution(mart(spark, sf_dir, "fact_transactions")))


def _flag_count(flag: str) -> str:
    name = "missing_customer" if flag == "is_missing_customer_id" else flag
    return f"count(CASE WHEN {flag} THEN 1 END) AS {name}"


@query(
    "bq3_quality_issues",
    sql(
        f"""SELECT count(*) AS total_transactions, count(CASE WHEN is_clean_record THEN 1 END) AS clean_records,
            {', '.join(_flag_count(f) for f in QUALITY_FLAGS)},
            {rounded('100 * count(CASE WHEN is_clean_record THEN 1 END)', 'count(*)')} AS clean_percentage FROM fact""",
        "fact",
    ),
)
def quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(R.quality_issues(mart(spark, sf_dir, "fact_transactions")))


@query(
    "bq4_dimension_completeness",
    sql(
        """SELECT 'Customers' AS dimension, count(*) AS total,
                  count(CASE WHEN is_unknown_customer THEN 1 END) AS unknown_count FROM dim_customers
           UNION ALL SELECT 'Products', count(*), 0 FROM dim_products
           UNION ALL SELECT 'Dates', count(*), 0 FROM calendar""",
        "dim_customers", "dim_products", "calendar",
    ),
)
def dimension_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.dimension_completeness(*[mart(spark, sf_dir, f"dim_{d}") for d in ("customers", "products", "dates")])


@query(
    "bq5_orphaned_keys",
    sql(
        """SELECT 'customers' AS dimension, count(*) AS orphaned_rows FROM fact f
           LEFT JOIN dim_customers c ON f.customer_key = c.customer_id WHERE c.customer_id IS NULL
           UNION ALL SELECT 'products', count(*) FROM fact f
           LEFT JOIN dim_products p ON f.product_key = p.product_id WHERE p.product_id IS NULL""",
        "fact", "dim_customers", "dim_products",
    ),
)
def orphaned_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.orphan_report(*[mart(spark, sf_dir, t) for t in ("fact_transactions", "dim_customers", "dim_products")])


@query(
    "bq6_top_customers",
    sql(
        """SELECT customer_name, total_revenue, total_transactions, customer_value_segment, customer_tier
           FROM dim_customers WHERE NOT is_unknown_customer ORDER BY total_revenue DESC, customer_name LIMIT 5""",
        "dim_customers",
    ),
)
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(R.top_customers(mart(spark, sf_dir, "dim_customers")))


@query(
    "bq7_products_by_revenue",
    sql(
        """SELECT product_name, product_category, total_revenue, total_quantity_sold, performance_segment
           FROM dim_products ORDER BY total_revenue DESC""",
        "dim_products",
    ),
)
def products_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(R.products_by_revenue(mart(spark, sf_dir, "dim_products")))


@query(
    "bq8_monthly_revenue_trend",
    sql(
        f"""SELECT year_month, {money('sum(rev_c)')} AS monthly_revenue, CAST(sum(n) AS BIGINT) AS total_transactions,
            count(DISTINCT customer_key) AS active_customers FROM monthly_metrics GROUP BY year_month ORDER BY year_month""",
        "monthly_metrics",
    ),
)
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(R.monthly_trend(mart(spark, sf_dir, "monthly_customer_summary")))


@query(
    "bq9_weekend_vs_weekday",
    sql(
        f"""SELECT is_weekend, count(*) AS transaction_count, {money('sum(tot_c)')} AS total_revenue,
            {money('sum(tot_c)')} / count(*) AS avg_transaction_value
            FROM fact JOIN calendar ON date_key = day_value GROUP BY is_weekend""",
        "fact", "calendar",
    ),
)
def weekend_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(R.weekend_split(mart(spark, sf_dir, "fact_transactions"), mart(spark, sf_dir, "dim_dates")))
