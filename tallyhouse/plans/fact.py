"""Transaction fact: one narrow pass over staging, keys computed, nothing joined."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.context import RunContext
from tallyhouse.functions.arithmetic import ratio
from tallyhouse.plans.customers import customer_key

# The flags that each cost one point of the quality score.
QUALITY_FLAGS = [
    "had_transaction_id_prefix",
    "is_missing_customer_id",
    "had_invalid_date",
    "had_product_id_prefix",
    "had_invalid_quantity",
    "had_text_in_price",
    "had_text_in_tax",
]
MARGIN = "0.3"


def admitted(stg: DataFrame) -> DataFrame:
    """Rows with an id, a product, a date and a total."""
    required = ["transaction_id", "product_id", "transaction_date", "line_total"]
    return stg.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required]))


def rate(tax: Column, base: Column) -> Column:
    """Tax as a percentage of ``base``; NULL instead of a failed build when it is 0."""
    return ratio(tax * 100, base)


def quality_score() -> Column:
    return F.lit(len(QUALITY_FLAGS)) - reduce(lambda a, b: a + b, [F.col(c).cast("int") for c in QUALITY_FLAGS])


def is_clean() -> Column:
    return ~reduce(lambda a, b: a | b, [F.col(c) for c in QUALITY_FLAGS])


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def fact_transactions(stg: DataFrame, ctx: RunContext) -> DataFrame:
    subtotal, total = F.col("line_subtotal"), F.col("line_total")
    return admitted(stg).select(
        "transaction_id",
        customer_key(F.col("customer_id")).alias("customer_key"),
        F.col("product_id").alias("product_key"),
        F.col("transaction_date").alias("date_key"),
        "product_name",
        F.coalesce("quantity", F.lit(0)).alias("quantity"),
        F.col("price").alias("unit_price"),
        F.col("tax").alias("tax_amount"),
        F.coalesce(subtotal, F.lit(0)).alias("line_subtotal"),
        F.coalesce(total, F.lit(0)).alias("line_total"),
        rate(F.col("tax"), F.col("price")).alias("tax_rate_percentage"),
        rate(F.col("tax"), subtotal).alias("effective_tax_rate"),
        (subtotal * F.lit(MARGIN).cast("decimal(1,1)")).alias("estimated_margin"),
        "is_bulk_purchase",
        F.col("customer_id").isNull().alias("is_guest_transaction"),
        _known(F.col("quantity") > 1).alias("is_multi_item"),
        _known(F.col("price") > 200).alias("is_premium_price"),
        _known(total > 500).alias("is_high_value_transaction"),
        *QUALITY_FLAGS,
        quality_score().alias("data_quality_score"),
        is_clean().alias("is_clean_record"),
        F.col("ingested_at").alias("source_ingested_at"),
        "source_file",
        "pipeline_run_id",
        ctx.now.alias("fact_created_at"),
    )
