"""Alert levels from deviations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric, direction, yellow and red limit of the deviation in percent.
# "above"/"below" compare the deviation itself, "pacing" compares the pacing percentage on both sides.
LEVELS = (
    ("cpa", "above", 15.0, 25.0),
    ("approval_rate", "below", -8.0, -15.0),
    ("funnel_stage", "below", -10.0, -20.0),
    ("roas", "below", -10.0, -20.0),
)
PACING_YELLOW = (85.0, 105.0)
PACING_RED = (75.0, 115.0)
HEADER_TRIGGERS = {"cpa": 20.0, "approval_rate": -10.0, "funnel_stage": -15.0, "pacing": 110.0}


def alert_level(metric: Column, value: Column) -> Column:
    """green, yellow or red; NULL for a missing value or a metric without limits."""
    level = F.when(value.isNull(), F.lit(None).cast("string"))
    for name, direction, yellow, red in LEVELS:
        here = metric == name
        over = (lambda limit: value >= limit) if direction == "above" else (lambda limit: value <= limit)
        level = level.when(here & over(red), "red").when(here & over(yellow), "yellow").when(here, "green")
    pacing = metric == "pacing"
    outside = lambda low, high: (value < low) | (value > high)
    return (
        level.when(pacing & outside(*PACING_RED), "red")
        .when(pacing & outside(*PACING_YELLOW), "yellow")
        .when(pacing, "green")
    )


def header_trigger(metric: Column, value: Column) -> Column:
    """Whether the value raises the alert of the dashboard header."""
    raised = (
        ((metric == "cpa") & (value > HEADER_TRIGGERS["cpa"]))
        | ((metric == "approval_rate") & (value < HEADER_TRIGGERS["approval_rate"]))
        | ((metric == "funnel_stage") & (value < HEADER_TRIGGERS["funnel_stage"]))
        | ((metric == "pacing") & (value > HEADER_TRIGGERS["pacing"]))
    )
    return F.coalesce(raised, F.lit(False))


def variance_colour(variance: Column) -> Column:
    # Borders of the variance colours.
    size = F.abs(variance)
    return F.when(size <= 5, "green").when(size <= 15, "yellow").when(size > 15, "red")


def classify(deviations: DataFrame) -> DataFrame:
    """``deviations`` has the columns metric, subject, value."""
    metric, value = F.col("metric"), F.col("value")
    return deviations.select(
        "metric",
        "subject",
        "value",
        alert_level(metric, value).alias("level"),
        header_trigger(metric, value).alias("header_alert"),
        variance_colour(value).alias("colour"),
    )


def header(alerts: DataFrame) -> DataFrame:
    """One row: is any header alert raised, and how many alerts are yellow and red."""
    return alerts.agg(
        F.coalesce(F.bool_or("header_alert"), F.lit(False)).alias("alert"),
        F.count_if(F.col("level") == "yellow").alias("yellow"),
        F.count_if(F.col("level") == "red").alias("red"),
    )


def deviations(kpis: DataFrame, pacing: DataFrame, funnel: DataFrame) -> DataFrame:
    """Deviations to classify: KPI variances, spend pacing and the latest change of each funnel stage.

    ``kpis`` has metric, channel, product, variance_pct; ``pacing`` channel, pacing_pct; ``funnel``
    week_start, stage_name, change_pct.
    """
    watched = kpis.where(F.col("metric").isin("cpa", "approval_rate", "roas")).select(
        "metric", F.concat_ws("/", "channel", "product").alias("subject"), F.col("variance_pct").alias("value")
    )
    paced = pacing.select(F.lit("pacing").alias("metric"), F.col("channel").alias("subject"), F.col("pacing_pct").alias("value"))
    latest = funnel.groupBy(F.col("stage_name").alias("subject")).agg(
        F.max(F.struct("week_start", "change_pct"))["change_pct"].alias("value")
    )
    stages = latest.select(F.lit("funnel_stage").alias("metric"), "subject", "value")
    return watched.unionByName(paced).unionByName(stages)
