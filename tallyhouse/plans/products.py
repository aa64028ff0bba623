"""Product dimension: one row per product id and name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.context import RunContext
from tallyhouse.functions.arithmetic import mean, ratio, safe_divide
from tallyhouse.operators.grouping import aggregate_with_distinct

# Product names per category.
CATEGORY_1 = ["PRODUCT A", "PRODUCT B"]
CATEGORY_2 = ["PRODUCT C", "PRODUCT D"]


def product_metrics(stg: DataFrame) -> DataFrame:
    """Volume, price, tax and revenue per (product, name).

    A hot product combines map-side to one row per task, and its days to one row
    per task and day.
    """
    quantity = F.coalesce(F.col("quantity"), F.lit(0))
    total = F.coalesce(F.col("line_total"), F.lit(0))
    rate = F.when(F.col("price") > 0, F.col("tax") / F.nullif(F.col("price"), F.lit(0)))
    return aggregate_with_distinct(
        stg.filter(F.col("transaction_id").isNotNull() & F.col("product_id").isNotNull()),
        ["product_id", "product_name"],
        [
            F.count(F.lit(1)).alias("total_transactions"),
            F.sum(quantity).alias("total_quantity_sold"),
            mean(quantity).alias("avg_quantity_per_transaction"),
            mean("price").alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.stddev_samp("price").alias("price_stddev"),
            (F.max("price") - F.min("price")).alias("price_range"),
            mean("tax").alias("avg_tax"),
            F.sum("tax").alias("total_tax_collected"),
            F.sum(total).alias("total_revenue"),
            mean(total).alias("avg_transaction_revenue"),
            F.min("transaction_date").alias("first_sale_date"),
            F.max("transaction_date").alias("last_sale_date"),
            F.avg(rate).alias("avg_tax_rate"),
        ],
        "transaction_date",
        "days_with_sales",
        nullable_keys=True,
    )


def product_category(name: Column) -> Column:
    return (
        F.when(name.isin(CATEGORY_1), "CATEGORY 1").when(name.isin(CATEGORY_2), "CATEGORY 2").otherwise("CATEGORY 3")
    )


def performance_segment(revenue: Column) -> Column:
    return F.when(revenue > 3000, "Top Performer").when(revenue > 1500, "Good Performer").otherwise("Low Performer")


def price_segment(avg_price: Column) -> Column:
    return F.when(avg_price > 200, "Premium").when(avg_price > 100, "Mid-Range").otherwise("Budget")


def price_stability(stddev: Column, avg_price: Column) -> Column:
    variation = safe_divide(stddev, avg_price)
    return (
        F.when(variation > 0.3, "High Variability").when(variation > 0.1, "Medium Variability").otherwise("Low Variability")
    )


def dim_products(stg: DataFrame, ctx: RunContext) -> DataFrame:
    """A renamed product gives two rows; the uniqueness test on the id shows it."""
    idle = F.datediff(ctx.today, F.col("last_sale_date"))
    revenue = F.col("total_revenue")
    return product_metrics(stg).select(
        "product_id",
        "product_name",
        product_category(F.col("product_name")).alias("product_category"),
        "total_transactions",
        "total_quantity_sold",
        "avg_quantity_per_transaction",
        "avg_price",
        "min_price",
        "max_price",
        "price_stddev",
        "price_range",
        "avg_tax",
        "total_tax_collected",
        F.round(F.col("avg_tax_rate") * 100, 2).alias("avg_tax_rate_percentage"),
        "total_revenue",
        "avg_transaction_revenue",
        ratio(revenue, F.col("total_transactions")).alias("revenue_per_transaction"),
        ratio(revenue, F.col("total_quantity_sold")).alias("revenue_per_unit"),
        "first_sale_date",
        "last_sale_date",
        "days_with_sales",
        idle.alias("days_since_last_sale"),
        performance_segment(revenue).alias("performance_segment"),
        price_segment(F.col("avg_price")).alias("price_segment"),
        price_stability(F.col("price_stddev"), F.col("avg_price")).alias("price_stability"),
        F.coalesce(idle > 7, F.lit(False)).alias("is_slow_moving"),
        ctx.now.alias("dim_created_at"),
        ctx.now.alias("dim_updated_at"),
    )
