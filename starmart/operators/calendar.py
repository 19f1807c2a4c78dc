"""Date and time dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import date_key, day_period, rush_hour_type
from starmart.sources.reference_rows import holidays


def date_dimension(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day of [start, end], holidays marked."""
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))
    return mark_holidays(describe_days(days))


def date_dimension_for(df: DataFrame, date_column: str) -> DataFrame:
    """Calendar covering the dates found in ``df``."""
    span = df.agg(F.min(date_column).cast("date").alias("a"), F.max(date_column).cast("date").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("date"))
    return mark_holidays(describe_days(days))


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``date`` column.

    Week is the ISO week while year is the calendar year; day_of_week counts from
    Sunday = 1, iso_day_of_week from Monday = 1; the fiscal year is the calendar year.
    """
    d = F.col("date")

    def start(unit: str):
        return F.trunc(d, unit)

    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        (F.weekday(d) + 1).alias("iso_day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
        F.month(d).alias("fiscal_month"),
        start("week").alias("week_start_date"),
        F.date_add(start("week"), 6).alias("week_end_date"),
        start("month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        start("quarter").alias("quarter_start_date"),
        F.date_sub(F.add_months(start("quarter"), 3), 1).alias("quarter_end_date"),
        start("year").alias("year_start_date"),
        F.date_sub(F.add_months(start("year"), 12), 1).alias("year_end_date"),
    )


def mark_holidays(days: DataFrame) -> DataFrame:
    rules = holidays(days.sparkSession)  # 14 rows
    marked = days.join(F.broadcast(rules), ["month", "day"], "left")
    return marked.select(*days.columns, F.col("holiday_name").isNotNull().alias("is_holiday"), "holiday_name")


def time_dimension(spark: SparkSession) -> DataFrame:
    """1 440 minutes."""
    hour, minute = F.floor(F.col("id") / 60).cast("int"), (F.col("id") % 60).cast("int")
    return spark.range(24 * 60, numPartitions=1).select(
        (hour * 10000 + minute * 100).alias("time_key"),
        F.format_string("%02d:%02d:00", hour, minute).alias("time"),
        hour.alias("hour"),
        minute.alias("minute"),
        F.lit(0).alias("second"),
        hour.alias("hour_of_day"),
        day_period(hour).alias("time_period"),
        rush_hour_type(hour).isNotNull().alias("is_rush_hour"),
        rush_hour_type(hour).alias("rush_hour_type"),
    )


def calendar_check(dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    dates = dim_date.agg(
        F.lit("dim_date").alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.min("date").cast("string").alias("first_value"),
        F.max("date").cast("string").alias("last_value"),
        F.count_if("is_weekend").alias("weekend_days"),
        F.count_if("is_holiday").alias("holiday_days"),
        F.lit(None).cast("bigint").alias("rush_hour_records"),
    )
    times = dim_time.agg(
        F.lit("dim_time").alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.min("time").alias("first_value"),
        F.max("time").alias("last_value"),
        F.lit(None).cast("bigint").alias("weekend_days"),
        F.lit(None).cast("bigint").alias("holiday_days"),
        F.count_if("is_rush_hour").alias("rush_hour_records"),
    )
    return dates.unionByName(times)
