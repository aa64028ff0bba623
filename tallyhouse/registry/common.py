"""What the queries share: the run, one warehouse per session and folder, output types."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.context import RunContext, shared_dir
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.dirty import dirty_transactions
from tallyhouse.sources.raw import write_landing

CTX = RunContext(datetime(2016, 8, 10, 6), "run-2016-08-10", "customer_transactions.csv")

_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}
_LANDED: set[str] = set()


def workspace(spark: SparkSession, sf_dir: str, name: str = "") -> str:
    """A folder of this session and source, below the shared folder."""
    source = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tallyhouse/{app}/{source}/{name}".rstrip("/")


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The tables other models read, built on first use and then reused.

    A registered model runs its own query over these tables every time it is
    called; only the tables it reads come from disk. Staging is a view: each reader parses
    only the text columns it needs, which takes less than writing all columns once.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse(
            spark, workspace(spark, sf_dir, "warehouse"), lambda: dirty_transactions(spark, sf_dir), CTX, staging_view=True
        )
    return _WAREHOUSES[key]


def landing(spark: SparkSession, sf_dir: str) -> str:
    """CSV files holding the dirty transactions."""
    path = workspace(spark, sf_dir, f"landing/{CTX.source_file}")
    if path not in _LANDED:
        write_landing(dirty_transactions(spark, sf_dir), path)
        _LANDED.add(path)
    return path


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).table("customer_transactions")


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).table("stg_transactions")


def mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return warehouse(spark, sf_dir).table(name)


def comparable(df: DataFrame, *drop: str) -> DataFrame:
    """Exact amounts as doubles and times as text, so that engines can be compared.

    Standard deviations are rounded: engines add up doubles in different orders.
    """

    def shown(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if f.name.endswith("stddev"):
            return F.round(f.name, 6).alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return F.col(f.name)

    return df.select(*[shown(f) for f in df.schema.fields if f.name not in drop])
