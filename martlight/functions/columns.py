"""Column helpers shared by the jobs. All of them stay inside generated JVM code."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that mean "missing" in exported spreadsheets.
MISSING_TEXTS = ("", "nan", "NaN", "NA", "N/A", "null", "NULL", "None")


def any_of(*conditions: Column) -> Column:
    return reduce(or_, conditions)


def one_of(column: str, values: tuple[str, ...]) -> str:
    """SQL condition: the column has one of the values."""
    return f"{column} IN ({', '.join(quoted(value) for value in values)})"


def quoted(text: str) -> str:
    """A SQL text literal without escapes."""
    return "r'" + text + "'"


def event_param(key: str, kind: str, params: str = "event_params", strict: bool = False) -> Column:
    """Value of one entry of a key/value parameter list, NULL when the key is absent.

    Written with array fields instead of a lambda filter: the scan then reads only the
    parameter fields that are asked for, and the projection stays in whole-stage codegen.
    """
    keys = F.col(f"{params}.key")
    index = F.array_position(keys, key).cast("int") - 1
    value = F.get(F.col(f"{params}.value.{kind}"), index)
    if not strict:
        return value
    copies = F.size(keys) - F.size(F.array_remove(keys, key))
    return F.when(copies > 1, F.raise_error(F.lit(f"event parameter {key!r} occurs twice"))).otherwise(value)


def ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """NULL instead of an error when the denominator is zero."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if scale == 1.0 else quotient * F.lit(float(scale))


def missing_to_null(column: Column) -> Column:
    trimmed = F.trim(column)
    return F.when(~trimmed.isin(*MISSING_TEXTS), trimmed)


def whole_number(column: Column) -> Column:
    """Text to bigint: fractions are cut off, anything unreadable is 0."""
    return F.coalesce(column.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def number(column: Column) -> Column:
    """Text to double: anything unreadable is 0."""
    return F.coalesce(F.nanvl(column.try_cast("double"), F.lit(0.0)), F.lit(0.0))


#: Forms of a date beside ISO.
DATE_FORMS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy", "yyyy/M/d", "d.M.yyyy", "MMM d, yyyy")


def try_date(text: Column) -> Column:
    """ISO, month-first, dotted day-first or month-name text to date; NULL if unreadable."""
    return F.coalesce(
        text.try_cast("date"),
        *[F.to_date(F.try_to_timestamp(text, F.lit(form))) for form in DATE_FORMS],
    )


def flexible_date(column: Column) -> Column:
    """Text to date like ``try_date``; unreadable text is an error, missing text is NULL."""
    text = missing_to_null(column)
    parsed = try_date(text)
    bad = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")
    return F.when(parsed.isNotNull() | text.isNull(), parsed).otherwise(bad)


def column_or(df: DataFrame, name: str, default: Column) -> Column:
    """The named column if the frame has it, else the default."""
    return F.col(f"`{name}`") if name in df.columns else default


def date_bucket(column: Column, unit: str) -> Column:
    """Start of the day, Monday week, month or quarter as a date."""
    return F.to_date(F.date_trunc(unit, column))
