"""LD: sources, sinks and load gates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.context import RunContext
from tallyhouse.operators import violations as V
from tallyhouse.plans.customers import dim_customers
from tallyhouse.plans.reports import layer_counts
from tallyhouse.plans.warehouse import LAYERS
from tallyhouse.quality.grading import Test, store_failures
from tallyhouse.registry import query
from tallyhouse.registry.common import CTX, comparable, landing, raw, staged, warehouse, workspace
from tallyhouse.registry.sqltext import sql
from tallyhouse.sources.raw import (
    RAW_COLUMNS,
    add_lineage,
    check_input,
    check_loaded,
    freshness,
    load_raw,
    profile,
    read_raw,
    union_all,
    write_landing,
)
from tallyhouse.sources.tables import table
from tallyhouse.sources.versions import read_table, reconcile, replace_table

_RAW = ", ".join(RAW_COLUMNS)


_BROKEN_NAME = """CASE WHEN transaction_id LIKE '%3' THEN product_name || chr(10) || '"x", y' ELSE product_name END"""


@query("ld1_csv_scan", sql(f"SELECT {_RAW.replace('product_name', f'{_BROKEN_NAME} AS product_name')} FROM raw", "raw"))
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth name holds a line break, quotes and a delimiter."""
    path = workspace(spark, sf_dir, "landing/broken_names")
    write_landing(raw(spark, sf_dir).withColumn("product_name", F.expr(_BROKEN_NAME)), path)
    return read_raw(spark, path)


@query("ld2_input_gate", sql("SELECT product_name, count(*) AS parsed_rows FROM raw GROUP BY product_name", "raw"))
def input_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_input(spark, landing(spark, sf_dir)).groupBy("product_name").agg(F.count(F.lit(1)).alias("parsed_rows"))


_TWICE = "transaction_id LIKE '%7'"


@query(
    "ld3_load_profile",
    sql(
        f"""SELECT count(*) AS total_rows, {len(RAW_COLUMNS)} AS total_columns,
            count(*) - (SELECT count(*) FROM (SELECT DISTINCT {_RAW} FROM raw)) AS duplicate_rows,
            {', '.join(f'count(*) - count({c}) AS null_{c}' for c in RAW_COLUMNS)}
            FROM (SELECT {_RAW} FROM raw UNION ALL SELECT {_RAW} FROM raw WHERE {_TWICE})""",
        "raw",
    ),
)
def load_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that brings every tenth row a second time."""
    rows = raw(spark, sf_dir).select(*RAW_COLUMNS)
    return profile(rows.unionByName(rows.filter(_TWICE)))


@query(
    "ld4_lineage_columns",
    sql(
        """SELECT transaction_id, '2016-08-10 06:00:00' AS ingested_at, 'customer_transactions.csv' AS source_file,
           'run-2016-08-10' AS pipeline_run_id, '2016-08-10 06:00:00' AS created_at FROM raw""",
        "raw",
    ),
)
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(add_lineage(raw(spark, sf_dir).select("transaction_id"), CTX))


@query("ld5_truncate_and_load", sql("SELECT transaction_id, product_id, price, pipeline_run_id FROM raw "
                                    "CROSS JOIN (SELECT 'second-run' AS pipeline_run_id)", "raw"))
def truncate_and_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading twice leaves the second load alone."""
    path = workspace(spark, sf_dir, "reload")
    source = raw(spark, sf_dir)
    for run in ("first-run", "second-run"):
        loaded = load_raw(spark, source, path, RunContext(CTX.run_ts, run, CTX.source_file))
    return loaded.select("transaction_id", "product_id", "price", "pipeline_run_id")


@query(
    "ld6_load_reconciliation",
    sql("SELECT product_id, count(*) AS stored_rows, (SELECT count(*) FROM raw) AS source_rows FROM raw GROUP BY product_id", "raw"),
)
def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, sf_dir, "reconciled")
    written = replace_table(raw(spark, sf_dir), path)
    stored = reconcile(spark, path, written)
    counts = read_table(spark, path).groupBy("product_id").agg(F.count(F.lit(1)).alias("stored_rows"))
    return counts.withColumn("source_rows", F.lit(stored).cast("bigint"))


@query(
    "ld7_loaded_table_gate",
    sql(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS non_null_rows FROM raw" for c in RAW_COLUMNS), "raw"),
)
def loaded_table_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = check_loaded(raw(spark, sf_dir)).agg(*[F.count(c).alias(c) for c in RAW_COLUMNS])
    return counts.unpivot([], RAW_COLUMNS, "column_name", "non_null_rows")


_LAYER_SQL = {
    "customer_transactions": "raw",
    "stg_transactions": "stg",
    "dim_customers": "dim_customers",
    "dim_products": "dim_products",
    "dim_dates": "calendar",
    "fact_transactions": "fact",
    "monthly_customer_summary": "monthly",
    "product_performance": "performance",
}


@query(
    "ld8_layered_materialization",
    sql(
        " UNION ALL ".join(
            f"SELECT '{LAYERS[t]}.{t}' AS layer, count(*) AS rows FROM {cte}" for t, cte in _LAYER_SQL.items()
        ),
        *_LAYER_SQL.values(),
    ),
)
def layered_materialization(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = warehouse(spark, sf_dir)
    return layer_counts({f"{layer}.{name}": tables.table(name) for name, layer in LAYERS.items()})


@query(
    "ld9_scd1_overwrite",
    sql(
        """SELECT customer_id, total_transactions, days_since_last_transaction + 1 AS days_since_last_transaction,
           '2016-08-11 06:00:00' AS dim_created_at, '2016-08-11 06:00:00' AS dim_updated_at FROM dim_customers""",
        "dim_customers",
    ),
)
def scd1_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's rebuild replaces the day before; no row of the first run stays."""
    path = workspace(spark, sf_dir, "scd1")
    for day in (10, 11):
        ctx = RunContext(datetime(2016, 8, day, 6), f"run-2016-08-{day}", CTX.source_file)
        replace_table(dim_customers(staged(spark, sf_dir), ctx), path)
    return comparable(
        read_table(spark, path).select(
            "customer_id", "total_transactions", "days_since_last_transaction", "dim_created_at", "dim_updated_at"
        )
    )


@query(
    "ld10_failing_row_sink",
    """SELECT 'price_range' AS test, o_orderkey FROM orders WHERE o_totalprice > 400000
       UNION ALL SELECT 'open_has_urgency', o_orderkey FROM orders WHERE NOT (o_orderstatus <> 'O' OR o_orderpriority <> '5-LOW')""",
)
def failing_row_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = [
        Test("price_range", lambda df: V.accepted_range(df, "o_totalprice", high=400000)),
        Test("open_has_urgency", lambda df: V.expression_is_true(df, "o_orderstatus <> 'O' OR o_orderpriority <> '5-LOW'")),
    ]
    paths = store_failures(tests, table(spark, sf_dir, "orders"), workspace(spark, sf_dir, "test_results"))
    return union_all([spark.read.parquet(p).select(F.lit(n).alias("test"), "o_orderkey") for n, p in paths.items()])


@query(
    "ld11_source_freshness",
    """SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest,
       CAST(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 06:00:00') // 1000000 AS BIGINT) AS age_seconds,
       CASE WHEN max(ts) < TIMESTAMP '2024-01-30 06:00:00' THEN 'error'
            WHEN max(ts) < TIMESTAMP '2024-01-31 06:00:00' THEN 'warn' ELSE 'pass' END AS status FROM events""",
)
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = RunContext(datetime(2024, 2, 1, 6), "run-2024-02-01", "events")
    return comparable(freshness(table(spark, sf_dir, "events"), "ts", ctx))
