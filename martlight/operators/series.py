"""Windows over aggregated time series: lag comparison, growth, rolling averages, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlight.functions.columns import ratio
from martlight.sources.readers import date_spine

# Every window below runs over one row per day or week of an already aggregated series, which the calendar
# bounds; without a series key that is a single small partition.


def _ordered(keys: tuple[str, ...], time: str):
    return Window.partitionBy(*keys).orderBy(time) if keys else Window.partitionBy(F.lit(1)).orderBy(time)


def dense_days(series: DataFrame, values: tuple[str, ...], keys: tuple[str, ...] = (), time: str = "date", step: str = "1 day") -> DataFrame:
    """Add the missing days of each series, from its first to its last, with 0 for the values."""
    bounds = series.groupBy(*keys).agg(F.min(time).alias("_from"), F.max(time).alias("_to"))
    days = bounds.where(F.col("_from").isNotNull()).select(
        *keys, F.explode(F.sequence(F.col("_from"), F.col("_to"), F.expr(f"interval {step}"))).alias(time)
    )
    joined = days.join(series, [*keys, time], "left") if not keys else days.alias("d").join(
        series.alias("s"),
        [F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys] + [F.col(f"d.{time}") == F.col(f"s.{time}")],
        "left",
    ).select(*[F.col(f"d.{k}") for k in keys], F.col(f"d.{time}"), *[F.col(f"s.{v}") for v in values])
    return joined.select(*keys, time, *[F.coalesce(v, F.lit(0)).alias(v) for v in values])


def lag_compare(series: DataFrame, value: str, lag: int = 7, keys: tuple[str, ...] = (), time: str = "date") -> DataFrame:
    """Each day with the value ``lag`` days before and the change in percent; the series must be dense."""
    before = F.lag(value, lag).over(_ordered(keys, time))
    with_lag = series.withColumn("previous", before)
    return with_lag.withColumn("change_pct", ratio(F.col(value) - F.col("previous"), F.col("previous"), 100))


def growth(series: DataFrame, value: str, keys: tuple[str, ...] = (), time: str = "week_start") -> DataFrame:
    """Period-over-period change; ``New`` where the previous period was zero and the current is not."""
    with_lag = series.withColumn("previous", F.lag(value).over(_ordered(keys, time)))
    label = F.when((F.col("previous") == 0) & (F.col(value) > 0), F.lit("New"))
    return with_lag.withColumn("change_pct", ratio(F.col(value) - F.col("previous"), F.col("previous"), 100)).withColumn(
        "change_label", label
    )


def trailing_average(value: str, days: int, keys: tuple[str, ...] = (), time: str = "date") -> Column:
    """Average of the ``days`` rows before the current one."""
    return F.avg(value).over(_ordered(keys, time).rowsBetween(-days, -1))


def share(value: str, keys: tuple[str, ...] = (), scale: float = 100) -> Column:
    """Part of the total of the group, in percent."""
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    return ratio(F.col(value), F.sum(value).over(group), scale)


def period_overlay(series: DataFrame, values: tuple[str, ...], start, days: int, time: str = "date", keys: tuple[str, ...] = ()) -> DataFrame:
    """Each day of a period next to the same day of the period before it, as ``previous_<value>``.

    The period is the ``days`` days from ``start``; days without data count as 0. With ``keys`` there is one series
    for each of their values that occurs in either period.
    """
    first = F.lit(start)
    both = series.where(F.col(time).between(F.date_sub(first, days), F.date_add(first, days - 1)))
    spine = date_spine(series.sparkSession, first, F.date_add(first, days - 1), both.select(*keys).distinct() if keys else None, keys)
    now = both.select(F.col(time).alias("date"), *keys, *values)
    old = both.select(F.date_add(time, days).alias("date"), *keys, *[F.col(v).alias(f"previous_{v}") for v in values])
    columns = [*values, *[f"previous_{v}" for v in values]]
    return (
        spine.join(now, ["date", *keys], "left")
        .join(old, ["date", *keys], "left")
        .select("date", *keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in columns])
    )
