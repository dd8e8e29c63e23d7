"""Data-quality checks: all checks of a table are one aggregation, then one row per check.

Every result has the columns suite, table, check, severity, passed, observed, threshold.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.functions.classify import CHANNEL_GROUPS
from martlight.functions.columns import any_of, ratio
from martlight.operators.series import dense_days, trailing_average

RESULT_COLUMNS = ("suite", "table", "check", "severity", "passed", "observed", "threshold")


@dataclass(frozen=True)
class Check:
    """``value`` is an aggregate; the check passes if it relates to the threshold as ``test`` says."""

    table: str
    name: str
    severity: str
    value: Column
    test: str
    threshold: float
    suite: str = "refresh"

    def passed(self, observed: Column) -> Column:
        limit = F.lit(float(self.threshold))
        relation = {
            ">": observed > limit,
            ">=": observed >= limit,
            "==": observed == limit,
            "<=": observed <= limit,
            "<": observed < limit,
        }[self.test]
        # Nothing measured is a failure, as an erroring check is.
        return F.coalesce(relation, F.lit(False))


def run_checks(frame: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks of one table in one pass."""
    measured = frame.agg(*[c.value.cast("double").alias(f"c{n}") for n, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.suite).alias("suite"),
            F.lit(c.table).alias("table"),
            F.lit(c.name).alias("check"),
            F.lit(c.severity).alias("severity"),
            c.passed(F.col(f"c{n}")).alias("passed"),
            F.col(f"c{n}").alias("observed"),
            F.lit(float(c.threshold)).alias("threshold"),
        )
        for n, c in enumerate(checks)
    ]
    return measured.select(F.inline(F.array(*rows)))


def not_run(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """Results of checks that could not run, because their table is missing or unreadable: all failed."""
    rows = [(c.suite, c.table, c.name, c.severity, False, None, float(c.threshold)) for c in checks]
    types = ("string", "string", "string", "string", "boolean", "double", "double")
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {t}" for n, t in zip(RESULT_COLUMNS, types)))


def _rows() -> Column:
    return F.count(F.lit(1))


def _nulls(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def null_pct(column: str) -> Column:
    return ratio(_nulls(column), _rows(), 100)


def out_of_range(column: str, low=None, high=None) -> Column:
    """Number of rows below ``low`` or above ``high``."""
    tests = []
    if low is not None:
        tests.append(F.col(column) < low)
    if high is not None:
        tests.append(F.col(column) > high)
    return F.count_if(any_of(*tests)) if tests else F.lit(0)


def days_old(as_of: date, column: str = "date") -> Column:
    return F.date_diff(F.lit(as_of), F.max(column))


def _on(day: date, back: int, column: str = "date") -> Column:
    return F.count_if(F.col(column) == F.date_sub(F.lit(day), back))


def refresh_checks(as_of: date) -> dict[str, list[Check]]:
    """The checks that follow every refresh."""
    # Names, severities and thresholds.
    return {
        "fact_sessions": [
            Check("fact_sessions", "No data for yesterday", "critical", _on(as_of, 1), ">", 0),
            Check("fact_sessions", "NULL sessions detected", "critical", _nulls("sessions"), "==", 0),
            Check("fact_sessions", "Negative users detected", "critical", out_of_range("users", 0), "==", 0),
            Check("fact_sessions", "Row count dropped significantly", "warning", _rows(), ">=", 50_000),
        ],
        "fact_conversions": [
            Check("fact_conversions", "No conversion data for yesterday", "critical", _on(as_of, 1), ">", 0),
            Check("fact_conversions", "NULL registrations detected", "critical", _nulls("registrations"), "==", 0),
        ],
        "dim_channel": [
            Check(
                "dim_channel",
                "Unknown channel_type detected",
                "warning",
                F.count_if(F.col("channel_type").isNull() | (F.col("channel_type") == "")),
                "==",
                0,
            )
        ],
    }


def suite_checks(as_of: date) -> dict[str, list[Check]]:
    """Row counts, null shares, freshness, ranges and totals of the marts."""
    # Minimum rows, columns, and limits.
    minimum_rows = {
        "fact_sessions": 1000,
        "fact_conversions": 1000,
        "fact_bank_conversions": 100,
        "dim_channel": 5,
        "dim_product": 3,
    }
    null_columns = {
        "fact_sessions": ("date", "channel_group"),
        "fact_conversions": ("date", "product_category"),
        "fact_bank_conversions": ("date", "channel_group", "loan_count"),
    }
    fresh = ("fact_sessions", "fact_conversions")
    not_negative = {
        "fact_sessions": ("sessions", "users"),
        "fact_bank_conversions": ("loan_count", "loan_amount", "card_count"),
    }
    max_null_pct, max_days = 5, 7
    checks = {
        table: [Check(table, "row count", "critical", _rows(), ">=", rows, "suite")]
        for table, rows in minimum_rows.items()
    }
    for table, columns in null_columns.items():
        checks[table] += [
            Check(table, f"{c} nulls", "critical", null_pct(c), "<=", max_null_pct, "suite") for c in columns
        ]
    for table in fresh:
        checks[table].append(Check(table, "freshness", "critical", days_old(as_of), "<=", max_days, "suite"))
    for table, columns in not_negative.items():
        checks[table] += [
            Check(table, f"{c} range", "critical", out_of_range(c, 0), "==", 0, "suite") for c in columns
        ]
    checks["fact_bank_conversions"] += [
        Check("fact_bank_conversions", "loans total", "critical", F.sum("loan_count"), ">", 0, "suite"),
        Check("fact_bank_conversions", "cards total", "critical", F.sum("card_count"), ">=", 0, "suite"),
        Check("fact_bank_conversions", "deposits total", "critical", F.sum("deposit_count"), ">=", 0, "suite"),
    ]
    return checks


def staging_checks(as_of: date) -> list[Check]:
    """Checks of the staged events: rows today, missing names, users, sessions, unknown channels."""
    known = F.coalesce(F.col("channel_group").isin(*CHANNEL_GROUPS), F.lit(False))
    return [
        Check("stg_events", "STG-01 rows today", "critical", _on(as_of, 0, "event_date"), ">", 0, "matrix"),
        Check("stg_events", "STG-02 event_name not null", "critical", _nulls("event_name"), "==", 0, "matrix"),
        Check("stg_events", "STG-03 user_pseudo_id not null", "critical", _nulls("user_pseudo_id"), "==", 0, "matrix"),
        Check("stg_events", "STG-04 session_id not null", "critical", _nulls("session_id"), "==", 0, "matrix"),
        Check(
            "stg_events",
            "STG-05 unknown channel_group pct",
            "warning",
            ratio(F.count_if(~known), _rows(), 100),
            "<=",
            1,
            "matrix",
        ),
    ]


def mart_checks(as_of: date) -> list[Check]:
    """Freshness, latest sessions and bounce range of the session fact."""
    latest = F.max(F.struct("date", "sessions"))["sessions"]
    bounce = ratio(F.sum("bounced_sessions"), F.sum("sessions"), 100)
    return [
        Check("fact_sessions", "MART-02 freshness", "critical", days_old(as_of), "<=", 2, "matrix"),
        Check("fact_sessions", "MART-03 latest sessions", "critical", latest, ">", 0, "matrix"),
        Check(
            "fact_sessions",
            "MART-05 bounce rate range",
            "critical",
            F.when(bounce.between(0, 100), 0).otherwise(1),
            "==",
            0,
            "matrix",
        ),
    ]


def spend_checks(as_of: date, table: str = "ad_spend") -> list[Check]:
    return [
        Check(table, "AD-01 rows yesterday", "warning", _on(as_of, 1), ">", 0, "matrix"),
        Check(table, "AD-02 negative cost", "critical", out_of_range("spend_usd", 0), "==", 0, "matrix"),
    ]


def volume_drop(fact: DataFrame, max_drop_pct: float = 30) -> DataFrame:
    """Rows per day against the average of the seven days before; too large a drop fails."""
    daily = dense_days(fact.groupBy("date").agg(_rows().alias("rows")), ("rows",))
    average = daily.withColumn("prior_avg", trailing_average("rows", 7))
    drop = ratio(F.col("prior_avg") - F.col("rows"), F.col("prior_avg"), 100)
    return average.withColumn("drop_pct", drop).withColumn(
        "passed", F.coalesce(F.col("drop_pct") < max_drop_pct, F.lit(True))
    )


def registration_band(fact: DataFrame, days: int = 30, band_pct: float = 50) -> DataFrame:
    """Registrations per day within half of the rolling average of the days before."""
    daily = dense_days(fact.groupBy("date").agg(F.sum("registrations").alias("registrations")), ("registrations",))
    average = daily.withColumn("rolling_avg", trailing_average("registrations", days))
    low, high = 1 - band_pct / 100, 1 + band_pct / 100
    inside = F.col("registrations").between(F.col("rolling_avg") * low, F.col("rolling_avg") * high)
    return average.withColumn("passed", F.coalesce(inside, F.lit(True)))


def channel_agreement(left: DataFrame, right: DataFrame) -> DataFrame:
    """Channel groups on one side only; ``counts_equal`` is the weaker test on the number of groups."""
    a = left.select("channel_group").distinct().withColumn("_left", F.lit(1))
    b = right.select("channel_group").distinct().withColumn("_right", F.lit(1))
    both = a.join(b, "channel_group", "full")
    return both.agg(
        F.count("_left").alias("left_channels"),
        F.count("_right").alias("right_channels"),
        (F.count("_left") == F.count("_right")).alias("counts_equal"),
        F.count_if(F.col("_left").isNull() | F.col("_right").isNull()).alias("only_on_one_side"),
    )


def duplicate_keys(frame: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Key combinations with more than one row and the surplus rows.

    Counted per key first, with map-side combine; NULL keys count as equal.
    """
    per_key = frame.groupBy(*keys).agg(_rows().alias("n"))
    return per_key.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum("n") - F.count(F.lit(1)), F.lit(0)).alias("surplus_rows"),
    )


def duplicate_key_rows(frame: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return frame.groupBy(*keys).agg(_rows().alias("n")).where(F.col("n") > 1)


def orphans(fact: DataFrame, dimension: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Fact key values without a dimension row, with their number of fact rows.

    ``keys`` maps fact to dimension columns. The fact is reduced to its key values first.
    """
    used = fact.groupBy(*keys).agg(_rows().alias("fact_rows"))
    known = dimension.select(*[F.col(d).alias(f) for f, d in keys.items()]).distinct()
    return used.join(known, list(keys), "left_anti")


def completeness(status: DataFrame, tables: int) -> DataFrame:
    """Whether every table of a refresh succeeded; ``status`` has the columns table, ok."""
    return run_checks(
        status,
        [Check("all marts", "MART-06 refresh completeness", "critical", F.count_if("ok"), ">=", tables, "matrix")],
    )


def related(
    sessions: DataFrame | None, conversions: DataFrame | None, bank: DataFrame | None, bank_rows: DataFrame | None,
    channels: DataFrame | None, grain: tuple[str, ...],
) -> list[tuple[DataFrame, Check]]:
    """The checks that compare tables, rows or days, each with the frame it runs on; those without their tables are left out.

    Repeated clients a day are for information.
    """
    surplus, failing = F.max("surplus_rows"), F.count_if(~F.col("passed"))
    found = []

    def compare(tables: tuple, frame: Callable[..., DataFrame], *check) -> None:
        if all(t is not None for t in tables):
            found.append((frame(*tables), Check(*check)))

    compare((sessions, conversions), channel_agreement, "fact_sessions", "channels agree with fact_conversions", "critical", F.max("only_on_one_side"), "==", 0, "suite")
    compare((sessions, bank), channel_agreement, "fact_sessions", "channels agree with fact_bank_conversions", "info", F.max("only_on_one_side"), "==", 0, "suite")
    compare((sessions,), lambda t: duplicate_keys(t, grain), "fact_sessions", "repeated grain", "critical", surplus, "==", 0, "suite")
    compare((bank_rows,), lambda t: duplicate_keys(t, ("event_date", "client_code")), "bank_conversions", "repeated clients a day", "info", surplus, "==", 0, "suite")
    compare((bank, channels), lambda t, c: orphans(t, c, {"channel_group": "channel_group"}), "fact_bank_conversions", "channels without a dimension row", "warning", _rows(), "==", 0, "matrix")
    compare((sessions,), volume_drop, "fact_sessions", "days with a drop of rows", "warning", failing, "==", 0, "matrix")
    compare((conversions,), registration_band, "fact_conversions", "days outside the band of registrations", "warning", failing, "==", 0, "matrix")
    return found


def relation_checks(sessions: DataFrame, conversions: DataFrame, bank: DataFrame, bank_rows: DataFrame, channels: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    """The checks that compare tables, rows or days, in the common columns."""
    found = related(sessions, conversions, bank, bank_rows, channels, grain)
    return reduce(DataFrame.unionByName, [run_checks(frame, [check]) for frame, check in found])


def summary(results: DataFrame) -> DataFrame:
    """Passed, failed and warning counts, the failed critical checks and the decision to go on."""
    failed = ~F.col("passed")
    critical = F.col("severity") == "critical"
    name = F.concat_ws(": ", "table", "check")
    return results.agg(
        F.count_if("passed").alias("passed"),
        F.count_if(failed & critical).alias("failed"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
        F.concat_ws("; ", F.array_sort(F.collect_list(F.when(failed & critical, name)))).alias("critical_failures"),
        (F.count_if(failed & critical) == 0).alias("ok"),
    )
