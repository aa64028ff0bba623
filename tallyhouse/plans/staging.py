"""Staging: every raw row kept, cleaned and flagged, in one narrow pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import cleaning as C
from tallyhouse.sources.raw import RAW_COLUMNS

LINEAGE = ["ingested_at", "source_file", "pipeline_run_id"]


def keep_raw(raw: DataFrame) -> DataFrame:
    """The inputs under ``raw_`` names, so that cleaned columns can take theirs."""
    return raw.select(*[F.col(c).alias(f"raw_{c}") for c in RAW_COLUMNS + LINEAGE])


def flag(df: DataFrame) -> DataFrame:
    """One two-valued flag per kind of damage."""
    return df.select(
        "*",
        C.is_missing(F.col("raw_transaction_id")).alias("is_missing_transaction_id"),
        C.has_prefix(F.col("raw_transaction_id"), "T").alias("had_transaction_id_prefix"),
        C.is_missing(F.col("raw_customer_id")).alias("is_missing_customer_id"),
        C.is_missing(F.col("raw_transaction_date")).alias("is_missing_transaction_date"),
        C.parse_date(F.col("raw_transaction_date")).isNull().alias("had_invalid_date"),
        C.has_prefix(F.col("raw_product_id"), "P").alias("had_product_id_prefix"),
        C.is_invalid_number(F.col("raw_quantity")).alias("had_invalid_quantity"),
        C.has_letters(F.col("raw_price")).alias("had_text_in_price"),
        C.has_letters(F.col("raw_tax")).alias("had_text_in_tax"),
    )


def clean(df: DataFrame) -> DataFrame:
    """Typed values. What cannot be read becomes NULL and stays visible as a flag.

    Identifiers are 64-bit: a feed of this size outgrows 32-bit numbers.
    """
    return df.select(
        "*",
        C.clean_id(F.col("raw_transaction_id"), "T").alias("transaction_id"),
        C.whole_number(F.col("raw_customer_id"), "bigint").alias("customer_id"),
        C.parse_date(F.col("raw_transaction_date")).alias("transaction_date"),
        C.clean_id(F.col("raw_product_id"), "P").alias("product_id"),
        C.standard_name(F.col("raw_product_name")).alias("product_name"),
        C.whole_number(F.col("raw_quantity")).alias("quantity"),
        C.parse_amount(F.col("raw_price")).alias("price"),
        C.parse_amount(F.col("raw_tax")).alias("tax"),
        *[F.col(f"raw_{c}").alias(c) for c in LINEAGE],
    )


def enrich(df: DataFrame, padded_names: bool = False) -> DataFrame:
    """Line amounts, date parts and the bulk flag."""
    day = F.col("transaction_date")
    return df.select(
        "*",
        C.line_subtotal(F.col("quantity"), F.col("price")).alias("line_subtotal"),
        C.line_total(F.col("quantity"), F.col("price"), F.col("tax")).alias("line_total"),
        F.year(day).alias("transaction_year"),
        F.month(day).alias("transaction_month"),
        F.dayofmonth(day).alias("transaction_day"),
        C.day_name(day, padded_names).alias("transaction_day_name"),
        C.month_name(day, padded_names).alias("transaction_month_name"),
        F.quarter(day).alias("transaction_quarter"),
        C.is_bulk(F.col("quantity")).alias("is_bulk_purchase"),
    )


def stg_transactions(raw: DataFrame, padded_names: bool = False) -> DataFrame:
    """Same rows as ``raw``. A reader of few columns pays for those columns only."""
    return enrich(clean(flag(keep_raw(raw))), padded_names)
