"""The dashboard charts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from martlight.operators.series import dense_days, lag_compare
from martlight.plans.queryspec import QuerySpec, run

SESSIONS, CONVERSIONS, CHANNELS, BANK = "fact_sessions", "fact_conversions", "dim_channel", "fact_bank_conversions"

BY_REGISTRATIONS = (("registrations", True),)
BY_REVENUE = (("revenue", True),)
LOAN_STAGES = (
    "loans_pageview", "loans_apply_click", "loans_sub_id", "loans_check_limit", "loans_phone_submit", "loans_otp_submit",
)
CARD_STAGES = (
    "cards_deposits_pageview", "cards_deposits_apply_click", "cards_deposits_sub_id", "cards_deposits_phone_submit",
    "registrations",
)

# Datasets, groupings, metrics and row limits of the charts.
CHARTS = {
    "total_sessions": QuerySpec(SESSIONS, ("sessions",)),
    "total_users": QuerySpec(SESSIONS, ("users",)),
    "total_registrations": QuerySpec(CONVERSIONS, ("registrations",)),
    "total_apply_clicks": QuerySpec(CONVERSIONS, ("applies",)),
    "bounce_rate": QuerySpec(SESSIONS, ("bounce_rate_pct",)),
    "conversion_rate": QuerySpec(CONVERSIONS, ("cvr_pct",)),
    "daily_performance_trend": QuerySpec(SESSIONS, ("sessions", "users"), grain="P1D"),
    "channel_contribution": QuerySpec(SESSIONS, ("sessions",), ("channel_group",), grain="P1W"),
    "channel_performance": QuerySpec(
        CONVERSIONS,
        ("total_sessions", "total_users", "applies", "registrations", "cvr_pct"),
        ("channel_group",),
        order=BY_REGISTRATIONS,
        limit=50,
    ),
    "top_campaigns": QuerySpec(
        CONVERSIONS,
        ("total_sessions", "applies", "registrations"),
        ("campaign", "channel_group"),
        order=BY_REGISTRATIONS,
        limit=20,
    ),
    "channel_trend": QuerySpec(SESSIONS, ("sessions",), ("channel_group",), grain="P1D"),
    "registrations_by_channel": QuerySpec(
        CONVERSIONS, ("registrations",), ("channel_group",), order=BY_REGISTRATIONS, limit=20
    ),
    "campaign_performance_matrix": QuerySpec(
        CONVERSIONS,
        ("total_sessions", "registrations", "applies"),
        ("campaign",),
        order=(("total_sessions", True),),
        limit=50,
    ),
    "paid_vs_organic": QuerySpec(CHANNELS, ("channels",), ("channel_type",), order=(("channels", True),), limit=10),
    "sessions_by_product": QuerySpec(
        SESSIONS, ("sessions",), ("product_category",), order=(("sessions", True),), limit=10
    ),
    "loans_funnel": QuerySpec(CONVERSIONS, ("loans_pageview",)),
    "loans_funnel_stages": QuerySpec(CONVERSIONS, LOAN_STAGES),
    "cards_deposits_funnel": QuerySpec(CONVERSIONS, CARD_STAGES),
    "funnel_by_channel": QuerySpec(
        CONVERSIONS,
        ("total_sessions", "applies", "registrations", "cvr_pct"),
        ("channel_group",),
        order=BY_REGISTRATIONS,
        limit=20,
    ),
    "registrations_trend": QuerySpec(CONVERSIONS, ("registrations",), grain="P1D"),
    "weekly_registration_cohorts": QuerySpec(
        CONVERSIONS,
        ("total_sessions", "applies", "registrations"),
        grain="P1W",
        order=(("date", True),),
        limit=10,
    ),
    "device_performance": QuerySpec(
        SESSIONS, ("sessions", "users", "bounce_rate_pct", "avg_duration_sec"), ("device_category",)
    ),
    "country_performance": QuerySpec(
        CONVERSIONS,
        ("total_sessions", "applies", "registrations"),
        ("country",),
        order=BY_REGISTRATIONS,
        limit=15,
    ),
    "new_vs_returning_users": QuerySpec(SESSIONS, ("sessions", "users", "bounce_rate_pct"), ("user_type",)),
    "armenia_cities": QuerySpec(
        CONVERSIONS,
        ("total_sessions", "registrations"),
        ("city",),
        filters=(("country", "==", "Armenia"),),
        order=BY_REGISTRATIONS,
        limit=10,
    ),
    "actual_loans": QuerySpec(BANK, ("loans",), grain="P1D", last_month=True, lag=7),
    "actual_cards": QuerySpec(BANK, ("cards",), grain="P1D", last_month=True, lag=7),
    "actual_deposits": QuerySpec(BANK, ("deposits",), grain="P1D", last_month=True, lag=7),
    "loan_revenue": QuerySpec(BANK, ("loan_revenue",), grain="P1D", last_month=True, lag=7),
    "deposit_revenue": QuerySpec(BANK, ("deposit_revenue",), grain="P1D", last_month=True, lag=7),
    "total_revenue": QuerySpec(BANK, ("revenue",), grain="P1D", last_month=True, lag=7),
    "revenue_by_channel": QuerySpec(
        BANK, ("revenue",), ("channel_group",), last_month=True, order=BY_REVENUE, limit=10
    ),
    "bank_conversions_by_channel": QuerySpec(
        BANK,
        ("loans", "cards", "deposits", "revenue"),
        ("channel_group",),
        last_month=True,
        order=(("loans", True),),
        limit=20,
    ),
    "loans_by_channel": QuerySpec(
        BANK, ("loans",), ("channel_group",), last_month=True, order=(("loans", True),), limit=10
    ),
    "full_funnel_by_bank_product": QuerySpec(
        BANK, ("loans", "cards", "deposits", "revenue"), ("product_category",), last_month=True
    ),
    "new_vs_returning_revenue": QuerySpec(
        BANK, ("revenue",), ("is_existing_customer",), last_month=True, order=BY_REVENUE, limit=10
    ),
    "top_campaigns_by_revenue": QuerySpec(
        BANK,
        ("loans", "cards", "revenue"),
        ("acquired_campaign", "channel_group"),
        last_month=True,
        order=(("loans", True),),
        limit=20,
    ),
}


def chart(name: str, datasets: dict[str, DataFrame], as_of: date | None = None) -> DataFrame:
    """One chart. A chart with a lag is a dense daily series next to its value some days before."""
    spec = CHARTS[name]
    result = run(spec, datasets[spec.dataset], as_of)
    if spec.lag is None:
        return result
    (value,) = spec.metrics
    return lag_compare(dense_days(result, (value,)), value, spec.lag)
