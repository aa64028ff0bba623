"""Monthly customer summary: one row per customer and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.context import RunContext
from tallyhouse.functions.arithmetic import mean, percentage, ratio
from tallyhouse.operators.grouping import aggregate_with_distinct

MONTH_COLUMNS = ["year", "month", "year_month", "quarter", "year_quarter"]


def monthly_tier(revenue: Column) -> Column:
    return F.when(revenue > 500, "High Performer").when(revenue > 200, "Medium Performer").otherwise("Low Performer")


def monthly_metrics(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact by customer and month.

    Active days are bits of the month, so products stay the only distinct count. The
    month fixes its year and quarter, so these are looked up after the grouping. The
    calendar table is small enough on disk for Spark to broadcast.
    """
    days = dates.select("date_day", "year_month")
    months = dates.select(*MONTH_COLUMNS).distinct()
    return aggregate_with_distinct(
        fact.join(days, F.col("date_key") == F.col("date_day")),
        ["customer_key", "year_month"],
        [
            F.count(F.lit(1)).alias("transaction_count"),
            F.bit_count(F.bit_or(F.expr("shiftleft(1, dayofmonth(date_key) - 1)"))).cast("bigint").alias("active_days"),
            F.sum("quantity").alias("total_quantity"),
            mean("quantity").alias("avg_quantity_per_transaction"),
            F.sum("line_subtotal").alias("total_subtotal"),
            F.sum("tax_amount").alias("total_tax"),
            F.sum("line_total").alias("total_revenue"),
            mean("line_total").alias("avg_transaction_value"),
            F.min("line_total").alias("min_transaction_value"),
            F.max("line_total").alias("max_transaction_value"),
            F.count_if("is_bulk_purchase").alias("bulk_purchase_count"),
            F.count_if("is_high_value_transaction").alias("high_value_transaction_count"),
            F.count_if("is_premium_price").alias("premium_price_count"),
            mean("data_quality_score").alias("avg_data_quality_score"),
            F.count_if("is_clean_record").alias("clean_record_count"),
        ],
        "product_key",
        "unique_products_purchased",
    ).join(months, "year_month")


def monthly_customer_summary(
    fact: DataFrame, dates: DataFrame, customers: DataFrame, ctx: RunContext
) -> DataFrame:
    who = customers.select(
        "customer_id", "customer_name", "is_unknown_customer", "customer_value_segment", "customer_tier"
    )
    n, revenue = F.col("transaction_count"), F.col("total_revenue")
    return (
        monthly_metrics(fact, dates)
        .join(who, F.col("customer_key") == F.col("customer_id"), "left")
        .select(
            "customer_key",
            "year_month",
            "year",
            "month",
            "quarter",
            "year_quarter",
            "customer_name",
            "is_unknown_customer",
            "customer_value_segment",
            "customer_tier",
            "transaction_count",
            "active_days",
            "unique_products_purchased",
            "total_quantity",
            "avg_quantity_per_transaction",
            "total_subtotal",
            "total_tax",
            "total_revenue",
            "avg_transaction_value",
            "min_transaction_value",
            "max_transaction_value",
            ratio(revenue, n).alias("revenue_per_transaction"),
            ratio(revenue, F.col("active_days")).alias("revenue_per_active_day"),
            "bulk_purchase_count",
            percentage(F.col("bulk_purchase_count"), n).alias("bulk_purchase_rate"),
            "high_value_transaction_count",
            percentage(F.col("high_value_transaction_count"), n).alias("high_value_transaction_rate"),
            "premium_price_count",
            "avg_data_quality_score",
            "clean_record_count",
            monthly_tier(revenue).alias("monthly_performance_tier"),
            ctx.now.alias("agg_created_at"),
        )
    )
