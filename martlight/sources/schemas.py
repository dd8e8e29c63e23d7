"""Explicit schemas of every input; nothing is inferred."""

from __future__ import annotations

EVENTS = """
    event_date string, event_timestamp bigint, event_name string, user_pseudo_id string, user_id string,
    platform string,
    event_params array<struct<key: string, value: struct<string_value: string, int_value: bigint>>>,
    traffic_source struct<source: string, medium: string, name: string>,
    device struct<category: string, mobile_brand_name: string, operating_system: string,
                  web_info: struct<browser: string>>,
    geo struct<country: string, city: string>
"""

AD_SPEND = """
    date date, channel string, campaign_name string, impressions bigint, clicks bigint, cost double, currency string
"""

GOOGLE_ADS_STATS = """
    data_date date, campaign_name string, ad_group_name string, impressions bigint, clicks bigint,
    cost_micros bigint, conversions double
"""

META_INSIGHTS = """
    date_start date, campaign_name string, adset_name string, impressions bigint, clicks bigint,
    spend double, reach bigint
"""

BANK_APPLICATIONS = """
    application_id string, application_date date, approved_date date, uploaded_at timestamp,
    product_type string, product_name string, status string, user_phone string, user_email string,
    amount double, currency string
"""

BANK_CONVERSIONS = """
    event_time_raw string, event_date date, event_name string, token_id string, acquired_source string,
    acquired_medium string, acquired_campaign string, client_code string, soc_card string,
    count_soc_card bigint, had_product string, is_first_interaction bigint, loan_count bigint,
    loan_amount double, deposit_count bigint, deposit_amount double, card_count bigint, uploaded_at timestamp
"""

APPROVALS_TEMPLATE = """
    application_id string, user_id string, product_type string, apply_date date, apply_source string,
    apply_campaign string, status string, approval_date date, rejection_reason string,
    approved_amount_amd double, revenue_amd double, notes string
"""

MONTHLY_TARGETS = "period date, metric string, channel string, product string, target_value double, notes string"

MONTHLY_BUDGETS = "period date, channel string, monthly_budget_usd double, daily_budget_usd double, notes string"

MANUAL_AD_SPEND = """
    date date, channel string, campaign string, adset string, creative string, impressions bigint,
    clicks bigint, spend_usd double, spend_amd double
"""

FACT_AD_SPEND = """
    date date, channel_group string, campaign string, impressions double, clicks double,
    spend_usd double, spend_amd double
"""
