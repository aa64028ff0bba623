"""DM, FT and AG: dimensions, fact and aggregates over the tables they read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans import customers as CU
from tallyhouse.plans import dates as DA
from tallyhouse.plans import fact as FA
from tallyhouse.plans import performance as PE
from tallyhouse.plans import products as PR
from tallyhouse.registry import query
from tallyhouse.registry.common import CTX, comparable, mart, staged, warehouse
from tallyhouse.registry.sqltext import (
    DAILY_COLUMNS,
    RATIO_COLUMNS,
    ROLLING_COLUMNS,
    TIER_COLUMN,
    TREND_COLUMN,
    money,
    rounded,
    sql,
)

_STAMPS = ("dim_created_at", "dim_updated_at", "fact_created_at", "agg_created_at")


@query(
    "dm1_unknown_member",
    sql(
        """SELECT customer_id AS customer_key, customer_name, is_unknown_customer, total_transactions
           FROM dim_customers""",
        "dim_customers",
    ),
)
def unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = CU.customer_key(F.col("customer_id"))
    counted = staged(spark, sf_dir).filter("transaction_id IS NOT NULL").groupBy(key.alias("customer_key"))
    return counted.agg(F.count(F.lit(1)).alias("total_transactions")).select(
        "customer_key",
        CU.customer_name(F.col("customer_key")).alias("customer_name"),
        (F.col("customer_key") == CU.UNKNOWN_KEY).alias("is_unknown_customer"),
        "total_transactions",
    )


_CUSTOMER_METRICS = [
    "customer_id", "first_transaction_date", "last_transaction_date", "total_transactions", "active_months",
    "active_days", "bulk_purchase_count", "total_revenue", "avg_transaction_value", "min_transaction_value",
    "max_transaction_value", "transaction_value_stddev", "customer_tenure_days", "bulk_purchase_percentage",
    "days_since_last_transaction",
]


@query("dm2_customer_metrics", sql(f"SELECT {', '.join(_CUSTOMER_METRICS)} FROM dim_customers", "dim_customers"))
def customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(CU.customer_metrics(staged(spark, sf_dir), CTX))


@query(
    "dm3_customer_segments",
    sql("SELECT customer_id, customer_status, customer_value_segment, customer_tier FROM dim_customers", "dim_customers"),
)
def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CU.dim_customers(staged(spark, sf_dir), CTX).select(
        "customer_id", "customer_status", "customer_value_segment", "customer_tier"
    )


@query("dm4_dim_customers", sql("SELECT * FROM dim_customers", "dim_customers"))
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(warehouse(spark, sf_dir).model("dim_customers"), *_STAMPS)


_PRODUCT_METRICS = [
    "product_id", "product_name", "total_transactions", "total_quantity_sold", "avg_quantity_per_transaction",
    "avg_price", "min_price", "max_price", "price_stddev", "price_range", "avg_tax", "total_tax_collected",
    "total_revenue", "avg_transaction_revenue", "first_sale_date", "last_sale_date", "days_with_sales",
]


@query("dm5_product_metrics", sql(f"SELECT {', '.join(_PRODUCT_METRICS)} FROM dim_products", "dim_products"))
def product_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(PR.product_metrics(staged(spark, sf_dir)).select(*_PRODUCT_METRICS))


_PRODUCT_SEGMENTS = [
    "product_id", "product_name", "product_category", "avg_tax_rate_percentage", "revenue_per_transaction",
    "revenue_per_unit", "days_since_last_sale", "performance_segment", "price_segment", "price_stability",
    "is_slow_moving",
]


@query("dm6_product_segments", sql(f"SELECT {', '.join(_PRODUCT_SEGMENTS)} FROM dim_products", "dim_products"))
def product_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(PR.dim_products(staged(spark, sf_dir), CTX).select(*_PRODUCT_SEGMENTS))


@query("dm7_dim_products", sql("SELECT * FROM dim_products", "dim_products"))
def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(warehouse(spark, sf_dir).model("dim_products"), *_STAMPS)


@query("dm8_observed_date_spine", sql("SELECT CAST(date_day AS VARCHAR) AS date_day FROM spine", "spine"))
def observed_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(DA.observed_spine(staged(spark, sf_dir)))


_ATTRIBUTES = [
    "date_day", "year", "month", "day", "quarter", "week_of_year", "day_of_week", "day_of_year", "day_name",
    "day_name_short", "month_name", "month_name_short", "year_month", "year_quarter", "year_week",
    "week_start_date", "week_end_date", "month_start_date", "month_end_date", "quarter_start_date",
    "quarter_end_date", "year_start_date", "year_end_date",
]
_DATE_FLAGS = [
    "is_weekend", "is_weekday", "is_month_start", "is_month_end", "is_current_month", "is_current_year",
    "relative_period", "days_ago", "days_ahead",
]


@query("dm9_calendar_attributes", sql(f"SELECT {', '.join(_ATTRIBUTES)} FROM calendar", "calendar"))
def calendar_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(DA.calendar_attributes(DA.observed_spine(staged(spark, sf_dir))))


@query("dm10_calendar_flags", sql(f"SELECT date_day, {', '.join(_DATE_FLAGS)} FROM calendar", "calendar"))
def calendar_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(DA.calendar_flags(DA.observed_spine(staged(spark, sf_dir)), CTX))


@query("dm11_dim_dates", sql("SELECT * EXCLUDE (day_value) FROM calendar", "calendar"))
def dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(warehouse(spark, sf_dir).model("dim_dates"), *_STAMPS)


_FACT_SQL = {
    "transaction_id": "transaction_id",
    "customer_key": "customer_key",
    "product_key": "product_key",
    "date_key": "CAST(date_key AS VARCHAR)",
    "product_name": "product_name",
    "quantity": "quantity",
    "unit_price": money("price_c"),
    "tax_amount": money("tax_c"),
    "line_subtotal": money("sub_c"),
    "line_total": money("tot_c"),
    "tax_rate_percentage": rounded("100 * tax_c", "price_c"),
    "effective_tax_rate": rounded("100 * tax_c", "sub_c"),
    "estimated_margin": "CAST(sub_c * 3 AS DOUBLE) / 1000",
    **{
        c: c
        for c in [
            "is_bulk_purchase", "is_guest_transaction", "is_multi_item", "is_premium_price",
            "is_high_value_transaction", *FA.QUALITY_FLAGS, "data_quality_score", "is_clean_record",
        ]
    },
    "source_ingested_at": "'2016-08-10 06:00:00'",
    "source_file": "'customer_transactions.csv'",
    "pipeline_run_id": "'run-2016-08-10'",
}


def _fact_query(name: str, columns: list[str]) -> None:
    body = "SELECT " + ", ".join(f"{_FACT_SQL[c]} AS {c}" for c in columns) + " FROM fact"

    @query(name, sql(body, "fact"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(warehouse(spark, sf_dir).model("fact_transactions").select(*columns))


@query(
    "ft1_admission_filter",
    sql(
        f"""SELECT transaction_id, product_key AS product_id, CAST(date_key AS VARCHAR) AS transaction_date,
            {money('tot_c')} AS line_total FROM fact""",
        "fact",
    ),
)
def admission_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(
        FA.admitted(staged(spark, sf_dir)).select("transaction_id", "product_id", "transaction_date", "line_total")
    )


_fact_query(
    "ft2_measures",
    [
        "transaction_id", "quantity", "unit_price", "tax_amount", "line_subtotal", "line_total",
        "tax_rate_percentage", "effective_tax_rate", "estimated_margin",
    ],
)
_fact_query(
    "ft3_business_flags",
    [
        "transaction_id", "is_bulk_purchase", "is_guest_transaction", "is_multi_item", "is_premium_price",
        "is_high_value_transaction",
    ],
)
_fact_query("ft4_quality_score", ["transaction_id", *FA.QUALITY_FLAGS, "data_quality_score", "is_clean_record"])
_fact_query("ft5_fact_transactions", list(_FACT_SQL))


@query("ag1_monthly_customer_summary", sql("SELECT * FROM monthly", "monthly"))
def monthly_customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(warehouse(spark, sf_dir).model("monthly_customer_summary"), *_STAMPS)


def _ranked(spark: SparkSession, sf_dir: str, daily: DataFrame) -> DataFrame:
    return PE.with_daily_rank(daily, mart(spark, sf_dir, "dim_products").count())


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PE.daily_rollup(mart(spark, sf_dir, "fact_transactions"), mart(spark, sf_dir, "dim_dates"))


_KEYS = "r.product_key, CAST(r.date_key AS VARCHAR) AS date_key"


@query(
    "ag2_daily_product_rollup",
    sql(
        f"""SELECT {_KEYS}, d.year, d.month, d.quarter, d.year_month, d.week_of_year, d.day_name, d.is_weekend,
            {DAILY_COLUMNS} FROM daily r JOIN calendar d ON r.date_key = d.day_value""",
        "daily",
        "calendar",
    ),
)
def daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_rollup(spark, sf_dir), "unit_price_sum")


@query("ag3_product_ratios", sql(f"SELECT {_KEYS}, {RATIO_COLUMNS} FROM daily r", "daily"))
def product_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(
        PE.with_ratios(_rollup(spark, sf_dir)).select(
            "product_key", "date_key", "revenue_per_transaction", "revenue_per_unit", "margin_percentage",
            "bulk_purchase_rate", "guest_purchase_rate", "price_variance", "price_variance_percentage",
        )
    )


@query("ag4_rolling_seven_days", sql(f"SELECT {_KEYS}, {ROLLING_COLUMNS} FROM rolling r", "rolling"))
def rolling_seven_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(
        PE.with_rolling(_rollup(spark, sf_dir)).select(
            "product_key", "date_key", "revenue_7day_avg", "quantity_7day_avg", "transaction_count_7day_avg"
        )
    )


@query(
    "ag5_daily_revenue_rank",
    sql(f"SELECT {_KEYS}, {money('rev_c')} AS total_revenue, CAST(rnk AS INTEGER) AS daily_revenue_rank FROM rolling r", "rolling"),
)
def daily_revenue_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(
        _ranked(spark, sf_dir, _rollup(spark, sf_dir)).select("product_key", "date_key", "total_revenue", "daily_revenue_rank")
    )


@query("ag6_trend_and_tier", sql(f"SELECT {_KEYS}, {TREND_COLUMN}, {TIER_COLUMN} FROM rolling r", "rolling"))
def trend_and_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = _ranked(spark, sf_dir, PE.with_rolling(_rollup(spark, sf_dir)))
    tier = PE.daily_tier(F.col("daily_revenue_rank")).alias("daily_performance_tier")
    return comparable(ranked.select("product_key", "date_key", "trend_indicator", tier))


@query("ag7_product_performance", sql("SELECT * FROM performance", "performance"))
def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(warehouse(spark, sf_dir).model("product_performance"), *_STAMPS)
