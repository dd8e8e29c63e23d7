"""Staging views over the raw inputs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.functions.classify import Site, channel_group, product_category, source_clean
from martlight.functions.columns import event_param
from martlight.sources.literals import event_mapping
from martlight.sources.readers import between_days


def stg_events(
    raw: DataFrame, site: Site = Site(), since: date | None = None, until: date | None = None, strict: bool = False
) -> DataFrame:
    """One row per event, flat and classified. A pure projection: works on streams as well.

    The date filter is applied to the raw day key, so that it reaches the partitions of the scan.
    """

    def text(key):
        return event_param(key, "string_value", strict=strict)

    def integer(key):
        return event_param(key, "int_value", strict=strict)

    base = between_days(raw, since, until).select(
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_timestamp"),
        "event_name",
        "user_pseudo_id",
        "user_id",
        integer("ga_session_id").alias("session_id"),
        integer("ga_session_number").alias("session_number"),
        text("page_location").alias("page_location"),
        text("page_title").alias("page_title"),
        text("page_referrer").alias("page_referrer"),
        F.col("traffic_source.source").alias("source"),
        F.col("traffic_source.medium").alias("medium"),
        F.col("traffic_source.name").alias("campaign"),
        text("Access Token Sub ID").alias("access_token_sub_id"),
        integer("engagement_time_msec").alias("engagement_time_msec"),
        integer("session_engaged").alias("session_engaged"),
        F.col("device.category").alias("device_category"),
        F.col("device.mobile_brand_name").alias("device_brand"),
        F.col("device.operating_system").alias("device_os"),
        F.col("device.web_info.browser").alias("browser"),
        F.col("geo.country").alias("country"),
        F.col("geo.city").alias("city"),
        "platform",
    )
    return base.select(
        "*",
        source_clean(site).alias("source_clean"),
        channel_group().alias("channel_group"),
        product_category(site).alias("product_category"),
    )


def stg_events_clean(
    staged: DataFrame,
    mapping: DataFrame | None = None,
    test_users: tuple[str, ...] = (),
    site: Site = Site(),
    documented: bool = False,
) -> DataFrame:
    """Staged events with cleaned names, flow, funnel step and test flag.

    The default mapping is a fixed list of 16 rows. A mapping of the caller's must have each event once.
    """
    if mapping is None:
        mapping = F.broadcast(event_mapping(staged.sparkSession, site, documented))
    else:
        repeated = mapping.groupBy("original_event").count().where("count > 1").head()
        if repeated:
            raise ValueError(f"the mapping has {repeated['original_event']!r} more than once")
    rules = mapping.select(
        "original_event", "clean_event", F.col("flow").alias("_flow"), F.col("funnel_step").alias("_step")
    )
    named = staged.join(rules, F.col("event_name") == F.col("original_event"), "left")
    is_test = F.col("event_name").startswith("test_") | F.col("event_name").startswith("exchange_")
    if test_users:
        is_test = is_test | F.col("user_pseudo_id").isin(*test_users)
    return named.select(
        *staged.columns,
        F.coalesce("clean_event", "event_name").alias("event_name_clean"),
        F.coalesce("_flow", F.lit("Other")).alias("flow_type"),
        F.col("_step").alias("funnel_step"),
        F.coalesce(is_test, F.lit(False)).alias("is_test_event"),
    )


def without_tests(clean: DataFrame) -> DataFrame:
    return clean.where(~F.col("is_test_event"))


def without_personal_data(staged: DataFrame, salt: str | None = None) -> DataFrame:
    """Staged rows as they may leave staging: no login id, no application token, no query text of page or referrer.

    With a ``salt``, which the caller keeps secret, a keyed hash stands for the login id.
    """
    safe = staged.withColumn("page_location", landing_page("page_location"))
    safe = safe.withColumn("page_referrer", F.regexp_replace("page_referrer", r"[?#][\s\S]*$", ""))
    if salt:
        inner = F.sha2(F.concat(F.lit(salt), F.col("user_id")), 256)
        safe = safe.withColumn("user_hash", F.sha2(F.concat(F.lit(salt), inner), 256))
    return safe.drop("user_id", "access_token_sub_id")


def landing_page(column: str):
    """Path of a page address, without query text and fragment."""
    return F.try_parse_url(F.col(column), F.lit("PATH"))


def stg_bank_applications(raw: DataFrame) -> DataFrame:
    """Applications with standardised texts, phone digits and currency."""

    def plain(name):
        return F.lower(F.trim(name)).alias(name)

    return raw.select(
        "application_id",
        "application_date",
        "approved_date",
        "uploaded_at",
        plain("product_type"),
        "product_name",
        plain("status"),
        F.regexp_replace("user_phone", "[^0-9+]", "").alias("user_phone"),
        plain("user_email"),
        "amount",
        F.upper("currency").alias("currency"),
    )


def stg_bank_conversions(raw: DataFrame) -> DataFrame:
    """Distinct bank rows that carry both a token and a client."""
    return raw.where(F.col("token_id").isNotNull() & F.col("client_code").isNotNull()).distinct()
