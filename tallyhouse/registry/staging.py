"""CL: cleaning and flagging, each over the whole raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.registry import query
from tallyhouse.registry.common import comparable, warehouse
from tallyhouse.registry.sqltext import money, sql
from tallyhouse.sources.raw import RAW_COLUMNS

# staging column -> its SQL over the ``stg`` table expression
_SQL = {
    **{f"raw_{c}": c for c in RAW_COLUMNS},
    "raw_ingested_at": "'2016-08-10 06:00:00'",
    "raw_source_file": "'customer_transactions.csv'",
    "raw_pipeline_run_id": "'run-2016-08-10'",
    **{
        c: c
        for c in [
            "is_missing_transaction_id", "had_transaction_id_prefix", "is_missing_customer_id",
            "is_missing_transaction_date", "had_invalid_date", "had_product_id_prefix", "had_invalid_quantity",
            "had_text_in_price", "had_text_in_tax",
        ]
    },
    "transaction_id": "tid",
    "customer_id": "cid",
    "transaction_date": "CAST(day AS VARCHAR)",
    "product_id": "pid",
    "product_name": "pname",
    "quantity": "qty",
    "price": money("price_c"),
    "tax": money("tax_c"),
    "ingested_at": "'2016-08-10 06:00:00'",
    "source_file": "'customer_transactions.csv'",
    "pipeline_run_id": "'run-2016-08-10'",
    "line_subtotal": money("sub_c"),
    "line_total": money("tot_c"),
    "transaction_year": "CAST(year(day) AS INTEGER)",
    "transaction_month": "CAST(month(day) AS INTEGER)",
    "transaction_day": "CAST(day(day) AS INTEGER)",
    "transaction_day_name": "strftime(day, '%A')",
    "transaction_month_name": "strftime(day, '%B')",
    "transaction_quarter": "CAST(quarter(day) AS INTEGER)",
    "is_bulk_purchase": "is_bulk_purchase",
}


def _register(name: str, columns: list[str]) -> None:
    body = "SELECT " + ", ".join(f"{_SQL[c]} AS {c}" for c in columns) + " FROM stg"

    @query(name, sql(body, "stg"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(warehouse(spark, sf_dir).model("stg_transactions").select(*columns))


_ID = "raw_transaction_id"
_register(
    "cl1_missing_flags",
    [_ID, "is_missing_transaction_id", "is_missing_customer_id", "is_missing_transaction_date"],
)
_register("cl2_prefix_flags", [_ID, "had_transaction_id_prefix", "had_product_id_prefix"])
_register("cl3_invalid_date_flag", [_ID, "raw_transaction_date", "had_invalid_date"])
_register("cl4_invalid_quantity_flag", [_ID, "raw_quantity", "had_invalid_quantity"])
_register("cl5_text_in_number_flags", [_ID, "had_text_in_price", "had_text_in_tax"])
_register("cl6_prefixed_ids", [_ID, "transaction_id", "raw_product_id", "product_id"])
_register("cl7_float_text_to_int", [_ID, "customer_id", "quantity"])
_register("cl8_dates", [_ID, "raw_transaction_date", "transaction_date"])
_register("cl9_decimals", [_ID, "raw_price", "price", "raw_tax", "tax"])
_register("cl10_names", [_ID, "raw_product_name", "product_name"])
_register("cl11_line_amounts", [_ID, "line_subtotal", "line_total"])
_register(
    "cl12_date_parts",
    [
        _ID, "transaction_year", "transaction_month", "transaction_day", "transaction_quarter",
        "transaction_day_name", "transaction_month_name",
    ],
)
_register("cl13_bulk_flag", [_ID, "quantity", "is_bulk_purchase"])
_register("cl14_raw_preservation", [c for c in _SQL if c.startswith("raw_")])
_register("cl15_stg_transactions", list(_SQL))
