"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlight.functions.columns import date_bucket

# Public holidays, month-day.
HOLIDAYS = ("01-01", "01-02", "01-06", "03-08", "04-24", "05-01", "05-09", "05-28", "07-05", "09-21", "12-31")


def sunday_week(date: Column) -> Column:
    """Week of the year where weeks start on Sunday and days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(date) - F.dayofweek(date) + 7) / F.lit(7)).cast("int")


def calendar_columns(date: Column, holidays: tuple[str, ...] = HOLIDAYS) -> list[Column]:
    return [
        date.alias("date_key"),
        date.alias("date"),
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        sunday_week(date).alias("week_of_year"),
        F.weekofyear(date).alias("iso_week"),
        F.dayofweek(date).alias("day_of_week"),
        F.date_format(date, "EEEE").alias("day_name"),
        F.dayofmonth(date).alias("day_of_month"),
        date_bucket(date, "week").alias("week_start"),
        date_bucket(date, "month").alias("month_start"),
        date_bucket(date, "quarter").alias("quarter_start"),
        F.dayofweek(date).isin(1, 7).alias("is_weekend"),
        F.date_format(date, "MM-dd").isin(*holidays).alias("is_holiday"),
    ]
