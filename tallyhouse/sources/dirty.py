"""Dirty, all-text transactions derived from ``lineitem`` and ``orders``.

The benchmark tables hold no dirty transactions, so the raw feed is derived from
them by a fixed rule: one transaction per (order, line number), with damage that
depends only on the transaction number, so that any engine derives the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.tables import table

# days that move order dates into the range the declared date tests accept
SHIFT_DAYS = 5479


def _money_text(cents: Column) -> Column:
    """Whole cents as text with two decimals; integers only, no float."""
    units = ((cents - cents % 100) / 100).cast("bigint").cast("string")
    return F.concat_ws(".", units, F.lpad((cents % 100).cast("string"), 2, "0"))


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight text columns; about one row in three is damaged in some way.

    ``(l_orderkey, l_linenumber)`` repeats in ``lineitem``. The repeats collapse
    map-side before the shuffle, so an order that holds many rows costs little.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.max("l_partkey").alias("pk"), F.max(F.col("l_quantity").cast("int")).alias("q"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    base = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "id", F.col("l_orderkey") * 7 + F.col("l_linenumber") - 1
    )

    def every(n: int) -> Column:
        return F.col("id") % n == 0

    day = F.date_add(F.col("o_orderdate").cast("date"), SHIFT_DAYS)
    number = F.col("id").cast("string")
    product = (100 + F.col("pk") % 50).cast("string")
    letter = F.substring(F.lit("EABCD"), (F.col("pk") % 5 + 1).cast("int"), F.lit(1))
    price = 5000 + (F.col("pk") * 7919 + F.col("l_orderkey") * 31) % 25000
    tax = 500 + (F.col("l_orderkey") * 13 + F.col("l_linenumber")) % 2500
    return base.select(
        F.when(every(10), F.concat(F.lit("T"), number)).otherwise(number).alias("transaction_id"),
        F.when(~every(7), F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("customer_id"),
        F.when(every(8), F.date_format(day, "dd-MM-yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("transaction_date"),
        F.when(every(15), F.concat(F.lit("P"), product)).otherwise(product).alias("product_id"),
        F.concat(F.lit(" Product "), letter).alias("product_name"),
        F.when(~every(6), F.concat((1 + F.col("q") % 5).cast("string"), F.lit(".0"))).alias("quantity"),
        F.when(every(9), F.lit("Two Hundred")).otherwise(_money_text(price)).alias("price"),
        F.when(every(11), F.lit("Fifteen")).otherwise(_money_text(tax)).alias("tax"),
    )
