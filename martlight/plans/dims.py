"""Dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlight.functions.calendar import HOLIDAYS, calendar_columns
from martlight.functions.classify import Site, channel_category, channel_group, channel_type, is_paid, source_clean
from martlight.sources.readers import date_spine


def dim_date(
    spark: SparkSession,
    start: Column | date = date(2025, 1, 1),
    end: Column | date = date(2027, 12, 31),
    holidays: tuple[str, ...] = HOLIDAYS,
    bounds: DataFrame | None = None,
) -> DataFrame:
    return date_spine(spark, start, end, bounds).select(*calendar_columns(F.col("date"), holidays))


def channel_pairs(raw: DataFrame, site: Site = Site()) -> DataFrame:
    """Distinct (source, channel) pairs of raw events.

    Reads two fields of the events and classifies distinct traffic sources instead of events.
    """
    sources = raw.select(
        F.col("traffic_source.source").alias("source"), F.col("traffic_source.medium").alias("medium")
    ).distinct()
    return sources.select(source_clean(site).alias("source_clean"), channel_group().alias("channel_group")).distinct()


def dim_channel(events: DataFrame) -> DataFrame:
    """Distinct (source, channel) pairs with their groupings.

    The classifiers allow at most 24 x 21 pairs, so numbering them in one partition is safe.
    """
    pairs = events.select("source_clean", "channel_group").distinct()
    number = F.row_number().over(Window.orderBy("channel_group", "source_clean"))
    group = F.col("channel_group")
    return pairs.select(
        number.cast("long").alias("channel_key"),
        "source_clean",
        "channel_group",
        channel_type(group).alias("channel_type"),
        is_paid(group).alias("is_paid"),
        channel_category(F.col("source_clean")).alias("channel_category"),
    )


def with_channel(fact: DataFrame, channels: DataFrame) -> DataFrame:
    """Star join on the whole natural key; the channel dimension is bounded by its classifiers."""
    keys = ["source_clean", "channel_group"]
    attributes = channels.select(*keys, "channel_key", "channel_type", "is_paid", "channel_category")
    return fact.join(F.broadcast(attributes), keys, "left")


def with_product(fact: DataFrame, products: DataFrame) -> DataFrame:
    attributes = products.select(
        F.col("product_name").alias("product_category"), "product_key", "product_group", "has_funnel"
    )
    return fact.join(F.broadcast(attributes), "product_category", "left")


def with_calendar(fact: DataFrame, dates: DataFrame, columns: tuple[str, ...] = ("week_start", "month_start", "is_weekend", "is_holiday")) -> DataFrame:
    """Star join to the calendar: one row per day, about a thousand for three years."""
    return fact.join(F.broadcast(dates.select("date", *columns)), "date", "left")
