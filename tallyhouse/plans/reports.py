"""Verification and business queries over the built layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.arithmetic import percentage, safe_divide
from tallyhouse.operators.violations import orphan_count
from tallyhouse.plans.fact import QUALITY_FLAGS
from tallyhouse.sources.raw import union_all


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows") for name, df in layers.items()]
    )


def score_distribution(fact: DataFrame) -> DataFrame:
    """Transactions per score with their share; the window sees eight rows at most."""
    counts = fact.groupBy("data_quality_score").agg(F.count(F.lit(1)).alias("transaction_count"))
    whole = F.sum("transaction_count").over(Window.partitionBy())
    return counts.withColumn("percentage", percentage(F.col("transaction_count"), whole)).orderBy(
        F.col("data_quality_score").desc()
    )


def quality_issues(fact: DataFrame) -> DataFrame:
    """How many fact rows carry each flag, and the share without any."""
    names = {"is_missing_customer_id": "missing_customer"}
    return fact.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if("is_clean_record").alias("clean_records"),
        *[F.count_if(c).alias(names.get(c, c)) for c in QUALITY_FLAGS],
        percentage(F.count_if("is_clean_record"), F.count(F.lit(1))).alias("clean_percentage"),
    )


def dimension_completeness(customers: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    def size(name: str, df: DataFrame, unknown) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("total"), unknown.cast("bigint").alias("unknown_count")).select(
            F.lit(name).alias("dimension"), "total", "unknown_count"
        )

    return union_all(
        [
            size("Customers", customers, F.count_if("is_unknown_customer")),
            size("Products", products, F.lit(0)),
            size("Dates", dates, F.lit(0)),
        ]
    )


def orphan_report(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Fact rows whose key a dimension lacks; fact keys are never NULL."""
    return union_all(
        [
            orphan_count(fact, "customer_key", customers, "customer_id").withColumn("dimension", F.lit("customers")),
            orphan_count(fact, "product_key", products, "product_id").withColumn("dimension", F.lit("products")),
        ]
    ).select("dimension", "orphaned_rows")


def top_customers(customers: DataFrame, n: int = 5) -> DataFrame:
    """Known customers by revenue; the name settles ties."""
    return (
        customers.filter(~F.col("is_unknown_customer"))
        .select("customer_name", "total_revenue", "total_transactions", "customer_value_segment", "customer_tier")
        .orderBy(F.col("total_revenue").desc_nulls_first(), "customer_name")
        .limit(n)
    )


def products_by_revenue(products: DataFrame) -> DataFrame:
    return products.select(
        "product_name", "product_category", "total_revenue", "total_quantity_sold", "performance_segment"
    ).orderBy(F.col("total_revenue").desc_nulls_first())


def monthly_trend(monthly: DataFrame) -> DataFrame:
    return (
        monthly.groupBy("year_month")
        .agg(
            F.sum("total_revenue").alias("monthly_revenue"),
            F.sum("transaction_count").alias("total_transactions"),
            # a customer has one row per month
            F.count("customer_key").alias("active_customers"),
        )
        .orderBy("year_month")
    )


def weekend_split(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Weekend against weekday. The fact collapses to days before it meets the calendar."""
    daily = fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("n"), F.sum("line_total").alias("revenue"))
    return (
        daily.join(dates.select("date_day", "is_weekend"), F.col("date_key") == F.col("date_day"))
        .groupBy("is_weekend")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.sum("revenue").alias("total_revenue"),
            safe_divide(F.sum("revenue").cast("double"), F.sum("n")).alias("avg_transaction_value"),
        )
    )
