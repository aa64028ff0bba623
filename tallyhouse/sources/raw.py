"""Landing files and the raw layer: scan, gate, profile, load, reconcile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.context import RunContext, scratch_table
from tallyhouse.sources.errors import LoadError
from tallyhouse.sources.records import csv_records
from tallyhouse.sources.versions import read_table, replace_table

# The column names of a transaction file, in file order.
RAW_COLUMNS = [
    "transaction_id",
    "customer_id",
    "transaction_date",
    "product_id",
    "product_name",
    "quantity",
    "price",
    "tax",
]

# Texts that the reader takes for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan with every column as text and the missing-value texts as NULL.

    Quoted fields may hold delimiters, quotes and line breaks. A record with more or
    fewer fields than the header is an error that shows it; so is a file with another
    header, or an unpaired quote. Counts quotes in a first pass over the files.
    """
    records = csv_records(spark, path, RAW_COLUMNS)
    schema = f"{RAW_SCHEMA.toDDL()}, __broken STRING"
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__broken"}
    # beside the number the filter stays above the parsing, which then happens once
    number = F.monotonically_increasing_id().alias("__number")
    fields = records.select(F.from_csv("value", F.lit(schema), options).alias("r"), "value", number)
    wrong = F.concat(F.lit(f"not {len(RAW_COLUMNS)} fields: "), F.left("value", F.lit(200)))
    whole = F.when(F.col("r.__broken").isNull(), F.lit(True)).otherwise(F.raise_error(wrong).cast("boolean"))
    text = fields.where((F.col("__number") >= 0) & whole).select("r.*")
    return text.select(*[F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)).alias(c) for c in RAW_COLUMNS])


def write_landing(df: DataFrame, path: str) -> None:
    """Write text rows as CSV files that ``read_raw`` reads back unchanged."""
    (
        df.select(*RAW_COLUMNS)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def check_input(spark: SparkSession, path: str) -> DataFrame:
    """Gate before a load: the files exist, are not empty and parse.

    Returns the scan. Besides the pass that counts quotes, reads only the first rows.
    """
    try:
        scan = read_raw(spark, path)
        # whole rows, as a header is only checked for the columns that are read
        empty = not scan.take(5)
    except Exception as problem:
        raise LoadError(f"cannot read {path}: {problem}") from problem
    if empty:
        raise LoadError(f"{path} holds no rows")
    return scan


def profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, repeated rows, and the NULLs of each column.

    Rows are looked for twice among pairs of hashes, so that the shuffle carries 16
    bytes a row, however wide it is. Only rows whose pair repeats are compared in full.
    """
    columns = df.columns
    # a NULL leaves a hash as it was, so each column is told from a missing one
    told = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    pair = {"__one": F.xxhash64(*told), "__two": F.xxhash64(F.lit("second"), *told)}
    hashed = df.withColumns(pair)
    repeated = hashed.groupBy(*pair).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*pair)
    # written, so that its size is known before the rows are read again
    alike = hashed.join(scratch_table(repeated, "repeated"), list(pair), "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    repeats = alike.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"))
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(columns)).alias("total_columns"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )
    order = ["total_rows", "total_columns", "duplicate_rows", *[f"null_{c}" for c in columns]]
    return counts.crossJoin(repeats).select(*order)


def add_lineage(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Where a row came from and which run brought it in."""
    return df.select(
        "*",
        ctx.now.alias("ingested_at"),
        F.lit(ctx.source_file).alias("source_file"),
        F.lit(ctx.run_id).alias("pipeline_run_id"),
        ctx.now.alias("created_at"),
    )


def check_loaded(df: DataFrame, required: list[str] = RAW_COLUMNS) -> DataFrame:
    """Gate after a load: rows are there and no required column is missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise LoadError(f"required columns are missing: {missing}")
    if df.isEmpty():
        raise LoadError("the loaded table is empty")
    return df


def load_raw(spark: SparkSession, source: DataFrame, path: str, ctx: RunContext) -> DataFrame:
    """Truncate-and-load with lineage, reconciled and gated."""
    replace_table(add_lineage(source.select(*RAW_COLUMNS), ctx), path)
    return check_loaded(read_table(spark, path))


def freshness(
    df: DataFrame, loaded_at: str, ctx: RunContext, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Age of the newest row: pass, warn or error. An empty table is an error."""
    newest = df.agg(F.max(loaded_at).cast("timestamp_ntz").alias("newest"))
    seconds = F.timestamp_diff("SECOND", F.col("newest"), ctx.now)
    return newest.select(
        "newest",
        seconds.alias("age_seconds"),
        F.when(F.col("newest").isNull() | (seconds > error_hours * 3600), "error")
        .when(seconds > warn_hours * 3600, "warn")
        .otherwise("pass")
        .alias("status"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
