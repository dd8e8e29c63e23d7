"""Ad spend facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.functions.columns import ratio
from martlight.sources.readers import USD_TO_AMD


def _rates(impressions: Column, clicks: Column, spend: Column) -> list[Column]:
    return [
        ratio(clicks, impressions, 100).alias("ctr"),
        ratio(spend, clicks).alias("cpc"),
        ratio(spend, impressions, 1000).alias("cpm"),
    ]


def fact_ad_spend_google(stats: DataFrame, usd_to_amd: float = USD_TO_AMD) -> DataFrame:
    usd = F.col("cost_micros").cast("double") / F.lit(1_000_000.0)
    return stats.where(F.col("data_date").isNotNull()).select(
        F.col("data_date").alias("date"),
        F.lit("Google Ads").alias("channel_group"),
        F.col("campaign_name").alias("campaign"),
        F.col("ad_group_name").alias("ad_group"),
        F.col("impressions").cast("double").alias("impressions"),
        F.col("clicks").cast("double").alias("clicks"),
        usd.alias("spend_usd"),
        (usd * F.lit(usd_to_amd)).alias("spend_amd"),
        *_rates(F.col("impressions"), F.col("clicks"), usd),
        F.col("conversions").cast("double").alias("conversions"),
        ratio(usd, F.col("conversions")).alias("cost_per_conversion"),
    )


def _meta(insights: DataFrame, label: str, usd_to_amd: float) -> DataFrame:
    usd = F.col("spend").cast("double")
    return insights.where(F.col("date_start").isNotNull()).select(
        F.to_date("date_start").alias("date"),
        F.lit(label).alias("channel_group"),
        F.col("campaign_name").alias("campaign"),
        F.col("adset_name").alias("ad_group"),
        F.col("impressions").cast("double").alias("impressions"),
        F.col("clicks").cast("double").alias("clicks"),
        usd.alias("spend_usd"),
        (usd * F.lit(usd_to_amd)).alias("spend_amd"),
        F.col("reach").cast("double").alias("reach"),
        *_rates(F.col("impressions"), F.col("clicks"), usd),
    )


def fact_ad_spend_meta(insights: DataFrame, usd_to_amd: float = USD_TO_AMD) -> DataFrame:
    """The single-platform variant, labelled as paid social and with reach."""
    return _meta(insights, "Paid Social", usd_to_amd).drop("ad_group")


def fact_ad_spend(google: DataFrame | None, insights: DataFrame, usd_to_amd: float = USD_TO_AMD) -> DataFrame:
    """All platforms, or Meta alone. Meta conversions are tracked elsewhere and are the number 0, not NULL."""
    meta = _meta(insights, "Meta Ads", usd_to_amd).drop("reach")
    zero = F.lit(0.0)
    meta = meta.withColumns({"conversions": zero, "cost_per_conversion": zero})
    return meta if google is None else google.where(F.col("date").isNotNull()).unionByName(meta)


def raw_spend(rows: DataFrame, usd_to_amd: float = USD_TO_AMD) -> DataFrame:
    """The generic landing table in the shape of the empty spend fact: cost is in USD or AMD by currency."""
    cost = F.col("cost")
    local = F.upper(F.col("currency")) == "AMD"
    return rows.select(
        "date",
        F.col("channel").alias("channel_group"),
        F.col("campaign_name").alias("campaign"),
        F.col("impressions").cast("double").alias("impressions"),
        F.col("clicks").cast("double").alias("clicks"),
        F.when(local, cost / F.lit(usd_to_amd)).otherwise(cost).alias("spend_usd"),
        F.when(local, cost).otherwise(cost * F.lit(usd_to_amd)).alias("spend_amd"),
    )
