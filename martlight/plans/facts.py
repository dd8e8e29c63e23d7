"""Session and conversion facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.functions.columns import one_of
from martlight.operators.distinct import Distinct, distinct_counts
from martlight.operators.funnels import key_column
from martlight.session import materialize

CONVERSION_KEYS = (
    "date", "source_clean", "channel_group", "campaign", "device_category", "product_category", "country", "city",
)
CLUSTER = ("channel_group", "product_category")

USER_SESSION = "concat(user_pseudo_id, cast(session_id as string))"


def session_rollup(staged: DataFrame) -> DataFrame:
    """Events rolled up to user, session and the fact keys; engagement is kept in whole milliseconds."""
    keys = {name: key_column(name) for name in CONVERSION_KEYS}
    keys |= {"user_pseudo_id": "user_pseudo_id", "session_id": "session_id"}
    keys["user_type"] = "IF(session_number = 1, 'New', 'Returning')"
    measures = ("event_name", "engagement_time_msec", "session_engaged")
    return (
        staged.selectExpr(*[f"{expression} AS {name}" for name, expression in keys.items()], *measures)
        .groupBy(*keys)
        .agg(
            F.expr("count_if(event_name = 'page_view') AS pageviews"),
            F.expr("sum(coalesce(engagement_time_msec, 0L)) AS engagement_msec"),
            F.max("session_engaged").alias("session_engaged"),
        )
    )


def fact_sessions(staged: DataFrame) -> DataFrame:
    """Sessions per day, source, campaign, device, product, place and user type.

    The user type is a grouping column, so the new users of a row are all of its users or none: one
    distinct count is enough and Spark needs no row copies. Averages are ratios of exact integer sums,
    so they do not depend on the order of the rows.
    """
    return sessions_of(session_rollup(staged))


def sessions_of(sessions: DataFrame) -> DataFrame:
    """The session fact from the rows of a roll-up."""
    rows = sessions.groupBy(*CONVERSION_KEYS, "user_type").agg(
        F.count_distinct("user_pseudo_id").alias("users"),
        F.expr("count(1) AS sessions"),
        F.expr("count_if(pageviews = 1 AND engagement_msec < 10000) AS bounced_sessions"),
        F.expr("sum(pageviews) AS pageviews"),
        F.expr("sum(engagement_msec) AS _msec"),
    )
    return rows.selectExpr(
        *CONVERSION_KEYS,
        "user_type",
        "users",
        "IF(user_type = 'New', users, 0L) AS new_users",
        "sessions",
        "bounced_sessions",
        "pageviews",
        "_msec / 1000.0D / sessions AS avg_session_duration_sec",
        "pageviews / CAST(sessions AS DOUBLE) AS avg_pages_per_session",
    )


def _event(*names: str, column: str = "event_name") -> str:
    return one_of(column, names)


def _page_view(*products: str) -> str:
    return f"event_name = 'page_view' AND {one_of('product_category', products)}"


def raw_conversions() -> dict[str, str | None]:
    # Conversion counts over the tracked event names.
    return {
        "loans_pageview": _page_view("Consumer Loans"),
        "loans_apply_click": _event("sprint_apply_button_click"),
        "loans_sub_id": _event("Get Sub ID sprint"),
        "loans_check_limit": _event("check_limit_click"),
        "loans_phone_submit": _event("phone_submited_sprint"),
        "loans_otp_submit": _event("otp_submited_sprint"),
        "cards_deposits_pageview": _page_view("Cards", "Deposits"),
        "cards_deposits_apply_click": _event("reg_apply_button_click", "cards_apply_button", "apply_button_click"),
        "cards_deposits_sub_id": _event("Get Sub ID"),
        "cards_deposits_phone_submit": _event("phone_submited_reg"),
        "registrations": _event("registration_success"),
    }


def clean_conversions() -> dict[str, str | None]:
    # Conversion counts over the cleaned event names.
    def clean(*names):
        return _event(*names, column="event_name_clean")

    return {
        "loans_pageview": _page_view("Consumer Loans"),
        "loans_apply_click": clean("sprint_apply_click"),
        "loans_sub_id": clean("sprint_sub_id_captured"),
        "loans_check_limit": clean("sprint_check_limit_click"),
        "loans_phone_submit": clean("sprint_phone_submitted"),
        "loans_completed": clean("sprint_check_limit_completed") + " AND NOT is_test_event",
        "cards_deposits_pageview": _page_view("Cards", "Deposits"),
        "cards_deposits_apply_click": clean("reg_apply_click", "cards_apply_click"),
        "cards_deposits_sub_id": clean("reg_sub_id_captured"),
        "cards_deposits_phone_submit": clean("reg_phone_submitted"),
        "registrations": clean("reg_completed"),
    }


def fact_conversions(staged: DataFrame, variant: str = "raw") -> DataFrame:
    """Distinct users per conversion step; ``variant`` is raw (staged) or clean (staged with clean names)."""
    steps = {"raw": raw_conversions, "clean": clean_conversions}[variant]()
    counts = distinct_counts(
        staged,
        {name: key_column(name) for name in CONVERSION_KEYS},
        [
            Distinct("user_pseudo_id", {"total_users": None, **steps}),
            Distinct(USER_SESSION, {"total_sessions": None}),
        ],
    )
    return counts.select(*CONVERSION_KEYS, "total_users", "total_sessions", *steps)


def user_sessions(staged: DataFrame, variant: str = "raw") -> DataFrame:
    """The session roll-up with the conversion steps of each session as bits: all that both facts need, of one pass."""
    steps = {"raw": raw_conversions, "clean": clean_conversions}[variant]()
    keys = {name: key_column(name) for name in CONVERSION_KEYS}
    keys |= {"user_pseudo_id": "user_pseudo_id", "session_id": "session_id"}
    keys["user_type"] = "IF(session_number = 1, 'New', 'Returning')"
    bits = Distinct("user_pseudo_id", dict(steps)).bits()
    rows = staged.selectExpr(*[f"{expression} AS {name}" for name, expression in keys.items()], "event_name", "engagement_time_msec", f"{bits} AS _bits")
    return rows.groupBy(*keys).agg(
        F.expr("count_if(event_name = 'page_view') AS pageviews"),
        F.expr("sum(coalesce(engagement_time_msec, 0L)) AS engagement_msec"),
        F.expr("bit_or(_bits) AS _bits"),
    )


def conversions_of(sessions: DataFrame, variant: str = "raw") -> DataFrame:
    """The conversion fact from the rows of ``user_sessions``."""
    steps = {"raw": raw_conversions, "clean": clean_conversions}[variant]()
    marks = {name: f"(_bits & {1 << n}L) <> 0" for n, name in enumerate(steps)}
    counts = distinct_counts(
        sessions, {name: name for name in CONVERSION_KEYS},
        [Distinct("user_pseudo_id", {"total_users": None, **marks}), Distinct(USER_SESSION, {"total_sessions": None})],
    )
    return counts.select(*CONVERSION_KEYS, "total_users", "total_sessions", *steps)


def both_facts(staged: DataFrame, variant: str = "raw") -> tuple[DataFrame, DataFrame]:
    """The session fact and the conversion fact from one pass over the events.

    The roll-up, one row for each user, session and keys, is stored once and read by both.
    """
    sessions = materialize(user_sessions(staged, variant), "user-sessions")
    return sessions_of(sessions), conversions_of(sessions, variant)


def fact_conversions_plain(staged: DataFrame, variant: str = "raw") -> DataFrame:
    """The same fact as one aggregation of plain distinct counts; kept as the yardstick of the bench and tests."""
    steps = {"raw": raw_conversions, "clean": clean_conversions}[variant]()
    keys = [F.expr(key_column(name)).alias(name) for name in CONVERSION_KEYS]
    return staged.groupBy(*keys).agg(
        F.count_distinct("user_pseudo_id").alias("total_users"),
        F.count_distinct(F.expr(USER_SESSION)).alias("total_sessions"),
        *[F.expr(f"count(DISTINCT IF({c}, user_pseudo_id, NULL)) AS {name}") for name, c in steps.items()],
    )
