"""Date dimension over the observed days, plus one day a week to either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.context import RunContext
from tallyhouse.functions.cleaning import day_name, month_name


def observed_spine(stg: DataFrame) -> DataFrame:
    """Distinct observed days, the first minus 7 and the last plus 7 days.

    Days without a transaction in between are left out; ``date_spine`` gives a
    gap-free calendar. No input days give no rows.
    """
    days = stg.select(F.col("transaction_date").alias("date_day")).filter("date_day IS NOT NULL").distinct()
    ends = days.agg(F.min("date_day").alias("first"), F.max("date_day").alias("last")).select(
        F.explode(F.array(F.date_sub("first", 7), F.date_add("last", 7))).alias("date_day")
    )
    return days.unionByName(ends.filter("date_day IS NOT NULL")).distinct()


def year_week(day: Column) -> Column:
    """Year, week of the month and week of the year, as one text: ``2023-228``."""
    of_month = F.ceil(F.dayofmonth(day) / 7).cast("string")
    of_year = F.lpad(F.ceil(F.dayofyear(day) / 7).cast("string"), 2, "0")
    return F.concat(F.year(day).cast("string"), F.lit("-"), of_month, of_year)


def calendar_attributes(spine: DataFrame, padded_names: bool = False) -> DataFrame:
    day = F.col("date_day")
    year_text = F.lpad(F.year(day).cast("string"), 4, "0")
    week, month, quarter, year = (
        F.date_trunc(unit, day).cast("date") for unit in ("week", "month", "quarter", "year")
    )
    return spine.select(
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        day_name(day, padded_names).alias("day_name"),
        F.date_format(day, "EEE").alias("day_name_short"),
        month_name(day, padded_names).alias("month_name"),
        F.date_format(day, "MMM").alias("month_name_short"),
        F.concat_ws("-", year_text, F.lpad(F.month(day).cast("string"), 2, "0")).alias("year_month"),
        F.concat(year_text, F.lit("-Q"), F.quarter(day).cast("string")).alias("year_quarter"),
        year_week(day).alias("year_week"),
        week.alias("week_start_date"),
        F.date_add(week, 6).alias("week_end_date"),
        month.alias("month_start_date"),
        F.last_day(day).alias("month_end_date"),
        quarter.alias("quarter_start_date"),
        F.date_sub(F.add_months(quarter, 3), 1).alias("quarter_end_date"),
        year.alias("year_start_date"),
        F.date_sub(F.add_months(year, 12), 1).alias("year_end_date"),
    )


def relative_period(day: Column, today: Column) -> Column:
    ago = F.datediff(today, day)
    return (
        F.when(ago == 0, "Today")
        .when(ago == 1, "Yesterday")
        .when((ago > 0) & (ago < 7), "Last 7 Days")
        .when((ago > 0) & (ago < 30), "Last 30 Days")
        .when(ago < 0, "Future")
        .otherwise("Historical")
    )


def calendar_flags(df: DataFrame, ctx: RunContext) -> DataFrame:
    day = F.col("date_day")
    weekend = F.dayofweek(day).isin(1, 7)
    this_year = F.year(day) == ctx.as_of.year
    return df.select(
        "*",
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        (F.dayofmonth(day) == 1).alias("is_month_start"),
        (day == F.last_day(day)).alias("is_month_end"),
        (this_year & (F.month(day) == ctx.as_of.month)).alias("is_current_month"),
        this_year.alias("is_current_year"),
        relative_period(day, ctx.today).alias("relative_period"),
        F.datediff(ctx.today, day).alias("days_ago"),
        F.datediff(day, ctx.today).alias("days_ahead"),
    )


def dim_dates(stg: DataFrame, ctx: RunContext, padded_names: bool = False) -> DataFrame:
    calendar = calendar_flags(calendar_attributes(observed_spine(stg), padded_names), ctx)
    return calendar.select("*", ctx.now.alias("dim_created_at"), ctx.now.alias("dim_updated_at"))
