"""Constant tables: product dimension, event mapping, channel codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlight.functions.classify import Site
from martlight.sources.readers import literal_table

DIM_PRODUCT_SCHEMA = """
    product_key int, product_name string, product_group string, description string, has_funnel boolean,
    apply_event string, sub_id_event string, check_limit_event string
"""

# The product dimension.
LOAN_EVENTS = (True, "sprint_apply_button_click", "Get Sub ID sprint", "check_limit_click")
REGISTRATION_EVENTS = (True, "Reg_apply_button_click", "Get Sub ID", None)
NO_EVENTS = (False, None, None, None)
PRODUCTS = (
    (1, "Consumer Loans", "Loans", "Sprint, 1-Click, Refinance loans", *LOAN_EVENTS),
    (2, "Car Loans", "Loans", "Auto/vehicle loans", *LOAN_EVENTS),
    (3, "Mortgage", "Loans", "Home mortgage loans", *LOAN_EVENTS),
    (4, "Cards", "Cards", "Credit and debit cards", *REGISTRATION_EVENTS),
    (5, "Deposits", "Deposits", "Savings and term deposits", *REGISTRATION_EVENTS),
    (6, "Digital Banking", "Services", "Mobile and online banking", *NO_EVENTS),
    (7, "Accounts", "Services", "Current and savings accounts", *NO_EVENTS),
    (8, "Business", "Business", "Business banking services", *NO_EVENTS),
    (9, "Salary Project", "Services", "Corporate salary programs", *NO_EVENTS),
    (10, "Campaigns", "Marketing", "Seasonal promotions", *NO_EVENTS),
    (11, "Homepage", "General", "Main website", *NO_EVENTS),
    (12, "Support & Info", "General", "Help and information pages", *NO_EVENTS),
    (13, "User Account", "General", "User profile pages", *NO_EVENTS),
    (14, "Other", "Other", "Uncategorized pages", *NO_EVENTS),
)

EVENT_MAPPING_SCHEMA = "original_event string, clean_event string, flow string, funnel_step int, category string"


def event_mapping_rows(site: Site) -> tuple[tuple, ...]:
    # Tracked event names, their cleaned names, flow, step and category.
    return (
        ("Get Sub ID sprint", "sprint_sub_id_captured", "Sprint", 3, "Consumer Loans"),
        ("phone_submited_sprint", "sprint_phone_submitted", "Sprint", 4, "Consumer Loans"),
        (f"login via {site.app_login} sprint", "sprint_login_via_mobile", "Sprint", 4, "Consumer Loans"),
        ("spint_ssn_sumpited", "sprint_ssn_submitted", "Sprint", 7, "Consumer Loans"),
        ("check_limit_click", "sprint_check_limit_click", "Sprint", 8, "Consumer Loans"),
        ("sprint_check_limit_comleted", "sprint_check_limit_completed", "Sprint", 9, "Consumer Loans"),
        ("Get Sub ID", "reg_sub_id_captured", "Registration", 2, "Cards/Deposits"),
        ("phone_submited_reg", "reg_phone_submitted", "Registration", 3, "Cards/Deposits"),
        ("ssn_submitted", "reg_ssn_submitted", "Registration", 4, "Cards/Deposits"),
        ("otp_email_verified", "reg_email_verified", "Registration", 5, "Cards/Deposits"),
        ("kyc_start", "kyc_started", "Registration", 6, "Cards/Deposits"),
        ("registration_success", "reg_completed", "Registration", 9, "Cards/Deposits"),
        ("sprint_apply_button_click", "sprint_apply_click", "Sprint", 2, "Consumer Loans"),
        ("reg_apply_button_click", "reg_apply_click", "Registration", 1, "Cards/Deposits"),
        ("cards_apply_button", "cards_apply_click", "Registration", 1, "Cards"),
        ("apply_button_click", "apply_click", "General", 1, "Multiple"),
    )


# The documented funnels use these names for the events the refresh calls differently.
DOCUMENTED_NAMES = {
    "Get Sub ID sprint": "sprint_otp_requested",
    "Get Sub ID": "reg_otp_requested",
    "check_limit_click": "check_limit_click",
    "kyc_start": "kyc_start",
}

# Codes used in target and budget files, and the channel group each stands for.
CHANNEL_CODES = (
    ("google_ads", "Google Ads"),
    ("meta_ads", "Meta Ads"),
    ("linkedin", "LinkedIn"),
    ("yandex", "Yandex"),
    ("email", "Email"),
    ("sms", "SMS"),
)


def dim_product(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DIM_PRODUCT_SCHEMA, list(PRODUCTS))


def event_mapping(spark: SparkSession, site: Site = Site(), documented: bool = False) -> DataFrame:
    """Cleaned names as the refresh expects them, or as the cleanup plan documents them.

    In the documented form the two events without a rule keep their name and belong to no flow.
    """
    rows = event_mapping_rows(site)
    if documented:
        unmapped = {event for event, name in DOCUMENTED_NAMES.items() if event == name}
        rows = [
            (event, DOCUMENTED_NAMES.get(event, clean), *rest)
            for event, clean, *rest in rows
            if event not in unmapped
        ]
    return literal_table(spark, EVENT_MAPPING_SCHEMA, [tuple(row) for row in rows])


def channel_codes(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "channel_code string, channel_group string", list(CHANNEL_CODES))
