"""Dashboard questions as data: dataset, grouping, metrics, filters, grain, order, limit."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.functions.columns import date_bucket
from martlight.functions.metrics import metric

GRAINS = {"P1D": "day", "P1W": "week", "P1M": "month"}


@dataclass(frozen=True)
class QuerySpec:
    """``order`` holds (column, descending) pairs; the grouping columns always break ties.

    ``filters`` holds (column, operator, value). ``last_month`` keeps the month before the report date.
    """

    dataset: str
    metrics: tuple[str, ...]
    groupby: tuple[str, ...] = ()
    filters: tuple[tuple[str, str, object], ...] = ()
    grain: str | None = None
    last_month: bool = False
    order: tuple[tuple[str, bool], ...] = ()
    limit: int | None = None
    lag: int | None = None


def condition(column: str, operator: str, value) -> Column:
    field = F.col(column)
    tests = {
        "==": lambda: field == value,
        "!=": lambda: field != value,
        ">=": lambda: field >= value,
        "<=": lambda: field <= value,
        ">": lambda: field > value,
        "<": lambda: field < value,
        "in": lambda: field.isin(*value),
        "between": lambda: field.between(*value),
    }
    return tests[operator]()


def last_month(as_of: date, column: str = "date") -> Column:
    """From one calendar month before the report date up to the day before it."""
    day = F.col(column)
    return (day >= F.add_months(F.lit(as_of), -1)) & (day < F.lit(as_of))


def run(spec: QuerySpec, dataset: DataFrame, as_of: date | None = None) -> DataFrame:
    frame = dataset
    for column, operator, value in spec.filters:
        frame = frame.where(condition(column, operator, value))
    if spec.last_month:
        frame = frame.where(last_month(as_of))
    keys = list(spec.groupby)
    if spec.grain is not None:
        frame = frame.withColumn("date", date_bucket(F.col("date"), GRAINS[spec.grain]))
        keys = ["date", *[k for k in keys if k != "date"]]
    result = frame.groupBy(*keys).agg(*[metric(name) for name in spec.metrics])
    if spec.order or spec.limit is not None:
        ordered = [F.col(c).desc() if descending else F.col(c).asc() for c, descending in spec.order]
        result = result.orderBy(*ordered, *[k for k in keys if k not in dict(spec.order)]) if ordered or keys else result
    return result if spec.limit is None else result.limit(spec.limit)
