"""Customer dimension: one row per customer, with -1 for unknown ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.context import RunContext
from tallyhouse.functions.arithmetic import percentage, safe_divide

# The unknown member.
UNKNOWN_KEY = -1
UNKNOWN_NAME = "Unknown Customer"


def customer_key(customer_id: Column) -> Column:
    return F.coalesce(customer_id, F.lit(UNKNOWN_KEY).cast("bigint"))


def customer_name(key: Column) -> Column:
    return F.when(key == UNKNOWN_KEY, UNKNOWN_NAME).otherwise(F.concat(F.lit("Customer "), key.cast("string")))


def customer_metrics(stg: DataFrame, ctx: RunContext) -> DataFrame:
    """Counts, revenue and recency per customer. A missing total counts as 0.

    Grouped by (customer, month) first. Both levels combine map-side, so a
    customer holding a third of the rows shuffles a few rows per task. Days become
    bits of a month, so distinct days and months need no distinct aggregate.
    """
    day = F.col("transaction_date")
    total = F.coalesce(F.col("line_total"), F.lit(0))
    months = (
        stg.filter(F.col("transaction_id").isNotNull())
        .groupBy(customer_key(F.col("customer_id")).alias("customer_id"), F.trunc(day, "month").alias("month"))
        .agg(
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
            F.count(F.lit(1)).alias("n"),
            F.bit_or(F.expr("shiftleft(1, dayofmonth(transaction_date) - 1)")).alias("days"),
            F.count_if("is_bulk_purchase").alias("bulk"),
            F.sum(total).alias("revenue"),
            F.min(total).alias("low"),
            F.max(total).alias("high"),
            F.var_pop(total).alias("variance"),
        )
    )
    # merged spread: what lies within the months, and between their means; the customer's
    # mean comes first, as a difference of two squares would lose small spreads of large sums
    own = W.partitionBy("customer_id")
    mean = F.sum("revenue").over(own).cast("double") / F.sum("n").over(own)
    off = F.col("revenue").cast("double") / F.col("n") - mean
    months = months.withColumn("between", F.col("n") * off * off)
    spread = F.sqrt((F.sum(F.col("variance") * F.col("n")) + F.sum("between")) / (F.sum("n") - 1))
    return (
        months.groupBy("customer_id")
        .agg(
            F.min("first_day").alias("first_transaction_date"),
            F.max("last_day").alias("last_transaction_date"),
            F.sum("n").alias("total_transactions"),
            F.count("month").alias("active_months"),
            F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).alias("active_days"),
            F.sum("bulk").alias("bulk_purchase_count"),
            F.sum("revenue").alias("total_revenue"),
            safe_divide(F.sum("revenue").cast("double"), F.sum("n")).alias("avg_transaction_value"),
            F.min("low").alias("min_transaction_value"),
            F.max("high").alias("max_transaction_value"),
            F.when(F.sum("n") > 1, F.when(F.min("low") == F.max("high"), 0.0).otherwise(spread)).alias(
                "transaction_value_stddev"
            ),
        )
        .select(
            "*",
            F.datediff("last_transaction_date", "first_transaction_date").alias("customer_tenure_days"),
            percentage(F.col("bulk_purchase_count"), F.col("total_transactions")).alias("bulk_purchase_percentage"),
            F.datediff(ctx.today, "last_transaction_date").alias("days_since_last_transaction"),
        )
    )


def customer_status(days_idle: Column) -> Column:
    return F.when(days_idle <= 7, "Active").when(days_idle <= 14, "At Risk").otherwise("Inactive")


def value_segment(revenue: Column) -> Column:
    return F.when(revenue > 1500, "High Value").when(revenue > 800, "Medium Value").otherwise("Low Value")


def customer_tier(avg_value: Column) -> Column:
    return F.when(avg_value > 200, "Premium").when(avg_value > 100, "Standard").otherwise("Budget")


def dim_customers(stg: DataFrame, ctx: RunContext) -> DataFrame:
    """Type 1 dimension: rebuilt whole, both audit stamps are the run's."""
    key = F.col("customer_id")
    return customer_metrics(stg, ctx).select(
        "customer_id",
        customer_name(key).alias("customer_name"),
        (key == UNKNOWN_KEY).alias("is_unknown_customer"),
        "first_transaction_date",
        "last_transaction_date",
        "customer_tenure_days",
        "total_transactions",
        "active_months",
        "active_days",
        "bulk_purchase_count",
        "bulk_purchase_percentage",
        "total_revenue",
        "avg_transaction_value",
        "min_transaction_value",
        "max_transaction_value",
        "transaction_value_stddev",
        "days_since_last_transaction",
        customer_status(F.col("days_since_last_transaction")).alias("customer_status"),
        value_segment(F.col("total_revenue")).alias("customer_value_segment"),
        customer_tier(F.col("avg_transaction_value")).alias("customer_tier"),
        ctx.now.alias("dim_created_at"),
        ctx.now.alias("dim_updated_at"),
    )
