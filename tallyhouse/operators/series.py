"""Number and date series, generated where they are used."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The date parts a spine can step by.
DATE_PARTS = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """1 to ``upper``, produced in parallel without an input."""
    if upper < 1:
        raise ValueError("the upper bound must be positive")
    return spark.range(1, upper + 1).withColumnRenamed("id", "generated_number")


def date_spine(
    spark: SparkSession, datepart: str, start: date | datetime | str, end: date | datetime | str
) -> DataFrame:
    """Every ``datepart`` from ``start`` up to, but without, ``end``.

    Steps are counted over whole date parts, so a month spine from any day of
    January to any day of March has two rows, on the start's day.
    """
    if datepart not in DATE_PARTS:
        raise ValueError(f"datepart must be one of {DATE_PARTS}, got {datepart!r}")
    whole_days = datepart not in ("second", "minute", "hour")

    def instant(x: date | datetime | str):
        return F.lit(str(x)).cast("timestamp_ntz")

    unit = datepart.upper()
    # weeks are counted from Sunday, while truncating starts them on Monday
    ahead = F.expr("INTERVAL 1 DAY") if datepart == "week" else F.expr("INTERVAL 0 DAY")
    first, last = (F.date_trunc(datepart, instant(x) + ahead) for x in (start, end))
    steps = spark.range(1).select(F.timestamp_diff(unit, first, last).alias("n")).first()["n"]
    spine = spark.range(max(steps, 0)).select(
        F.timestamp_add(unit, F.col("id"), instant(start)).alias(f"date_{datepart}")
    )
    spine = spine.filter(F.col(f"date_{datepart}") <= instant(end))
    if whole_days and not isinstance(start, datetime) and ":" not in str(start):
        spine = spine.select(F.col(f"date_{datepart}").cast("date").alias(f"date_{datepart}"))
    return spine
