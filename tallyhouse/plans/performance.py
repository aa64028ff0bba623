"""Daily product performance: rollup, ratios, seven-day means, rank and trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.context import RunContext
from tallyhouse.functions.arithmetic import mean, percentage, ratio
from tallyhouse.operators.grouping import aggregate_with_distinct
from tallyhouse.operators.ordering import with_rank

DAY_COLUMNS = ["year", "month", "quarter", "year_month", "week_of_year", "day_name", "is_weekend"]


def daily_rollup(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact by product and day, with the day's calendar columns.

    The calendar is joined after the grouping: a day fixes its own attributes, so
    the join meets one row per product and day instead of every transaction.
    """
    measures = [
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("quantity").alias("total_quantity"),
        mean("quantity").alias("avg_quantity_per_transaction"),
        F.sum("line_subtotal").alias("total_subtotal"),
        F.sum("tax_amount").alias("total_tax"),
        F.sum("line_total").alias("total_revenue"),
        mean("unit_price").alias("avg_unit_price"),
        F.sum("unit_price").alias("unit_price_sum"),
        F.min("unit_price").alias("min_unit_price"),
        F.max("unit_price").alias("max_unit_price"),
        F.sum("estimated_margin").alias("total_estimated_margin"),
        F.count_if("is_bulk_purchase").alias("bulk_purchase_count"),
        F.count_if("is_guest_transaction").alias("guest_purchase_count"),
    ]
    daily = aggregate_with_distinct(
        fact, ["product_key", "date_key"], measures, "customer_key", "unique_customers"
    )
    calendar = dates.select("date_day", *DAY_COLUMNS)
    return daily.join(calendar, F.col("date_key") == F.col("date_day")).drop("date_day")


def with_ratios(daily: DataFrame) -> DataFrame:
    n, revenue = F.col("transaction_count"), F.col("total_revenue")
    spread = F.col("max_unit_price") - F.col("min_unit_price")
    return daily.select(
        "*",
        ratio(revenue, n).alias("revenue_per_transaction"),
        ratio(revenue, F.col("total_quantity")).alias("revenue_per_unit"),
        ratio(F.col("total_estimated_margin") * 100, revenue).alias("margin_percentage"),
        percentage(F.col("bulk_purchase_count"), n).alias("bulk_purchase_rate"),
        percentage(F.col("guest_purchase_count"), n).alias("guest_purchase_rate"),
        spread.alias("price_variance"),
        # over the mean price, written as one division of exact numbers
        F.when(F.col("avg_unit_price") > 0, ratio(spread * 100 * n, F.col("unit_price_sum"))).alias(
            "price_variance_percentage"
        ),
    )


def with_rolling(daily: DataFrame) -> DataFrame:
    """Means over the rows of the last seven calendar days, per product.

    A product has at most one row per day, so a window partition is no longer than
    the calendar. The trend compares products, not a rounded mean.
    """
    week = (
        Window.partitionBy("product_key").orderBy(F.unix_date("date_key").asc_nulls_last()).rangeBetween(-6, 0)
    )
    rows = F.count(F.lit(1)).over(week)

    def mean(c: str) -> Column:
        return F.round(F.sum(c).over(week) / rows, 2)

    revenue = F.col("total_revenue")
    scaled = revenue * F.col("__rows") * 10
    return (
        daily.select(
            "*",
            F.sum("total_revenue").over(week).alias("__sum"),
            rows.alias("__rows"),
            mean("total_revenue").alias("revenue_7day_avg"),
            F.round(F.sum("total_quantity").over(week).cast("decimal(20,0)") / rows, 2).alias("quantity_7day_avg"),
            F.round(F.sum("transaction_count").over(week).cast("decimal(20,0)") / rows, 2).alias(
                "transaction_count_7day_avg"
            ),
        )
        .withColumn(
            "trend_indicator",
            F.when(scaled > F.col("__sum") * 12, "Above Trend")
            .when(scaled < F.col("__sum") * 8, "Below Trend")
            .otherwise("On Trend"),
        )
        .drop("__sum", "__rows")
    )


def with_daily_rank(daily: DataFrame, products: int | None = None) -> DataFrame:
    """Revenue rank within the day. A day holds at most one row per product, if that number is known."""
    return with_rank(daily, ["date_key"], "total_revenue", "daily_revenue_rank", largest_group=products)


def daily_tier(rank: Column) -> Column:
    return F.when(rank <= 2, "Top Performer").when(rank <= 4, "Good Performer").otherwise("Standard Performer")


def daily_trends(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """What windows say of a product's day, from three measures alone.

    The two window shuffles and sorts carry five narrow columns instead of the whole
    rollup; the fact is read a second time for it, but only four of its columns. A
    product with two names counts twice in a day's ranks, as it has two rows there.
    """
    keys = ["product_key", "date_key"]
    thin = fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total").alias("total_revenue"),
    )
    thin = thin.join(dates.select("date_day"), F.col("date_key") == F.col("date_day"), "left_semi")
    thin = thin.join(products.select("product_id"), F.col("product_key") == F.col("product_id"), "left").drop("product_id")
    # the count comes from the footers of a written dimension
    judged = with_daily_rank(with_rolling(thin), products.count())
    return judged.drop("transaction_count", "total_quantity", "total_revenue").dropDuplicates(keys)


def product_performance(
    fact: DataFrame, dates: DataFrame, products: DataFrame, ctx: RunContext
) -> DataFrame:
    """A product with two names in the dimension appears once per name."""
    what = products.select(
        "product_id", "product_name", "product_category", "performance_segment", "price_segment", "price_stability"
    )
    named = daily_rollup(fact, dates).join(what, F.col("product_key") == F.col("product_id"), "left")
    return with_ratios(named.join(daily_trends(fact, dates, products), ["product_key", "date_key"])).select(
        "product_key",
        "date_key",
        "product_name",
        "product_category",
        "performance_segment",
        "price_segment",
        "price_stability",
        *DAY_COLUMNS,
        "transaction_count",
        "unique_customers",
        "total_quantity",
        "avg_quantity_per_transaction",
        "total_subtotal",
        "total_tax",
        "total_revenue",
        "avg_unit_price",
        "min_unit_price",
        "max_unit_price",
        "revenue_per_transaction",
        "revenue_per_unit",
        "total_estimated_margin",
        "margin_percentage",
        "price_variance",
        "price_variance_percentage",
        "bulk_purchase_count",
        "bulk_purchase_rate",
        "guest_purchase_count",
        "guest_purchase_rate",
        "revenue_7day_avg",
        "quantity_7day_avg",
        "transaction_count_7day_avg",
        "daily_revenue_rank",
        "trend_indicator",
        daily_tier(F.col("daily_revenue_rank")).alias("daily_performance_tier"),
        ctx.now.alias("agg_created_at"),
    )
