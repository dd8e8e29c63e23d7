"""One definition per metric, shared by every chart and report.

Mart metrics are aggregate expressions over mart columns. Contract metrics are distinct counts over staged
events and ratios of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.functions.columns import one_of, ratio
from martlight.operators.distinct import Distinct, distinct_counts

APPLIES = "sum(loans_apply_click) + sum(cards_deposits_apply_click)"

MART_METRICS = {
    # fact_sessions
    "sessions": "sum(sessions)",
    "users": "sum(users)",
    "new_users": "sum(new_users)",
    "pageviews": "sum(pageviews)",
    "bounce_rate_pct": "try_divide(sum(bounced_sessions), sum(sessions)) * 100",
    "avg_duration_sec": "avg(avg_session_duration_sec)",
    "weighted_duration_sec": "try_divide(sum(avg_session_duration_sec * sessions), sum(sessions))",
    "pages_per_session": "try_divide(sum(pageviews), sum(sessions))",
    # fact_conversions
    "total_sessions": "sum(total_sessions)",
    "total_users": "sum(total_users)",
    "registrations": "sum(registrations)",
    "applies": APPLIES,
    "sub_ids": "sum(loans_sub_id) + sum(cards_deposits_sub_id)",
    "cvr_pct": f"try_divide(sum(registrations), {APPLIES}) * 100",
    **{
        name: f"sum({name})"
        for name in (
            "loans_pageview", "loans_apply_click", "loans_sub_id", "loans_check_limit", "loans_phone_submit",
            "loans_otp_submit", "cards_deposits_pageview", "cards_deposits_apply_click", "cards_deposits_sub_id",
            "cards_deposits_phone_submit",
        )
    },
    # dim_channel
    "channels": "count(channel_key)",
    # fact_bank_conversions
    "loans": "sum(loan_count)",
    "cards": "sum(card_count)",
    "deposits": "sum(deposit_count)",
    "loan_revenue": "sum(loan_amount)",
    "deposit_revenue": "sum(deposit_amount)",
    "revenue": "sum(total_revenue_amd)",
    # fact_ad_spend; a cost per conversion of 0 means "not tracked" and stays out of the average
    "spend_usd": "sum(spend_usd)",
    "spend_amd": "sum(spend_amd)",
    "impressions": "sum(impressions)",
    "clicks": "sum(clicks)",
    "ctr_pct": "try_divide(sum(clicks), sum(impressions)) * 100",
    "cpc_usd": "try_divide(sum(spend_usd), sum(clicks))",
    "cpm_usd": "try_divide(sum(spend_usd), sum(impressions)) * 1000",
    "avg_cost_per_conversion": "avg(nullif(cost_per_conversion, 0))",
}


def metric(name: str) -> Column:
    return F.expr(MART_METRICS[name]).alias(name)


APPLY_EVENTS = ("sprint_apply_button_click", "reg_apply_button_click", "cards_apply_button", "apply_button_click")


def contract_metrics(staged: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The contract metrics over staged events, per ``keys`` or over everything.

    Sessions come in the three readings in use: distinct session ids, distinct concatenations of user and
    session id, distinct (user, session id) pairs.
    """
    users = Distinct(
        "user_pseudo_id",
        {
            "users": None,
            "new_users": "session_number = 1",
            "registrations": "event_name = 'registration_success'",
            "sub_id_loans": "event_name = 'Get Sub ID sprint'",
            "sub_id_cards": "event_name = 'Get Sub ID'",
            "sub_ids": one_of("event_name", ("Get Sub ID", "Get Sub ID sprint")),
            "apply_clicks": one_of("event_name", APPLY_EVENTS),
        },
    )
    sessions = Distinct("session_id", {"sessions": None})
    joined = Distinct("concat(user_pseudo_id, CAST(session_id AS STRING))", {"user_sessions": None})
    pairs = Distinct("concat(user_pseudo_id, ' ', CAST(session_id AS STRING))", {"session_pairs": None})
    views = {"pageviews": "IF(event_name = 'page_view', 1, 0)"}
    both = distinct_counts(staged, {k: k for k in keys}, [users, sessions, joined, pairs], views)
    return both.select(
        *both.columns,
        ratio(F.col("registrations"), F.col("sessions"), 100).alias("session_to_registration_pct"),
        ratio(F.col("pageviews"), F.col("sessions")).alias("pages_per_session"),
        ratio(F.col("apply_clicks"), F.col("sessions"), 100).alias("session_to_apply_pct"),
        ratio(F.col("sub_ids"), F.col("apply_clicks"), 100).alias("apply_to_sub_id_pct"),
        ratio(F.col("registrations"), F.col("sub_ids"), 100).alias("sub_id_to_registration_pct"),
    )


def session_quality(staged: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Bounce rate by engagement and average duration, over sessions (user and session id)."""
    per_session = staged.groupBy(*keys, "user_pseudo_id", "session_id").agg(
        F.max("session_engaged").alias("_engaged"), F.sum("engagement_time_msec").alias("_msec")
    )
    result = per_session.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("session_rows"),
        F.count_if(F.coalesce(F.col("_engaged"), F.lit(0)) == 0).alias("not_engaged"),
        F.sum("_msec").alias("_total"),
        F.count("_msec").alias("_timed"),
    )
    return result.select(
        *keys,
        "session_rows",
        "not_engaged",
        ratio(F.col("not_engaged"), F.col("session_rows"), 100).alias("bounce_rate_pct"),
        (ratio(F.col("_total"), F.col("_timed")) / F.lit(1000.0)).alias("avg_session_duration_sec"),
    )
