"""Funnels: distinct users per step, as a specification and its long form."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlight.functions.columns import one_of, quoted, ratio
from martlight.operators.distinct import Distinct, distinct_counts


@dataclass(frozen=True)
class Step:
    """Users with one of ``events``; optionally only on ``pages`` (product categories), optionally without tests."""

    name: str
    events: tuple[str, ...]
    pages: tuple[str, ...] = ()
    skip_tests: bool = False

    def condition(self) -> str:
        tests = [one_of("event_name_clean", self.events)]
        if self.pages:
            tests.append(one_of("product_category", self.pages))
        if self.skip_tests:
            tests.append("NOT is_test_event")
        return " AND ".join(tests)


@dataclass(frozen=True)
class Funnel:
    """Population (products or flow), grouping columns and steps."""

    name: str
    products: tuple[str, ...]
    flow: str
    keys: tuple[str, ...]
    steps: tuple[Step, ...]

    def population(self) -> str:
        return f"({one_of('product_category', self.products)} OR flow_type = {quoted(self.flow)})"


NOT_SET = "(not set)"


def key_column(name: str) -> str:
    """Grouping columns of the facts and funnels: ``date`` is the event date, an absent campaign is labelled."""
    return {"date": "event_date", "campaign": f"coalesce(campaign, '{NOT_SET}')"}.get(name, name)


def funnel(events: DataFrame, spec: Funnel) -> DataFrame:
    """Distinct users of every step per key combination."""
    return distinct_counts(
        events.where(spec.population()),
        {name: key_column(name) for name in spec.keys},
        [Distinct("user_pseudo_id", {step.name: step.condition() for step in spec.steps})],
    )


# The two funnels the daily refresh builds.
LOANS = Funnel(
    "Loans",
    ("Consumer Loans",),
    "Sprint",
    ("date", "channel_group", "campaign", "device_category"),
    (
        Step("step1_apply_click", ("sprint_apply_click",)),
        Step("step2_sub_id_captured", ("sprint_sub_id_captured",)),
        Step("step3_open_account", ("sprint_open_personal_account",)),
        Step("step4_ssn_submitted", ("sprint_ssn_submitted",)),
        Step("step5_check_limit", ("sprint_check_limit_click",)),
        Step("step6_completed", ("sprint_check_limit_completed",), skip_tests=True),
    ),
)
REGISTRATION = Funnel(
    "Registration",
    ("Cards", "Deposits", "Homepage"),
    "Registration",
    ("date", "channel_group", "campaign", "product_category", "device_category"),
    (
        Step("step1_apply_click", ("reg_apply_click", "cards_apply_click")),
        Step("step2_sub_id_captured", ("reg_sub_id_captured",)),
        Step("step3_phone_submitted", ("reg_phone_submitted",)),
        Step("step4_kyc_started", ("kyc_started",)),
        Step("step5_completed", ("reg_completed",)),
    ),
)
# The two funnels of the cleanup plan; they use the documented event names.
DOCUMENTED_LOANS = Funnel(
    "Loans",
    ("Consumer Loans",),
    "Sprint",
    ("date", "channel_group", "raw_campaign"),
    (
        Step("step1_pageview", ("page_view",), pages=("Consumer Loans",)),
        Step("step2_apply_click", ("sprint_apply_click",)),
        Step("step3_otp", ("sprint_otp_requested",)),
        Step("step4_phone", ("sprint_phone_submitted", "sprint_login_via_mobile")),
        Step("step5_check_limit", ("check_limit_click",)),
        Step("step6_completed", ("sprint_check_limit_completed",)),
    ),
)
DOCUMENTED_REGISTRATION = Funnel(
    "Registration",
    ("Cards", "Deposits"),
    "Registration",
    ("date", "channel_group", "raw_campaign", "product_category"),
    (
        Step("step1_apply_click", ("reg_apply_click",)),
        Step("step2_otp", ("reg_otp_requested",)),
        Step("step3_phone", ("reg_phone_submitted",)),
        Step("step4_ssn", ("reg_ssn_submitted",)),
        Step("step5_email", ("reg_email_verified",)),
        Step("step6_kyc_start", ("kyc_start",)),
        Step("step7_kyc_complete", ("kyc_qr_scanned",)),
        Step("step8_completed", ("reg_completed",)),
    ),
)


def documented_funnel(events: DataFrame, spec: Funnel) -> DataFrame:
    """The cleanup plan groups by the campaign as it is, without the label for absent ones."""
    result = funnel(events.withColumn("raw_campaign", F.col("campaign")), spec)
    return result.withColumnRenamed("raw_campaign", "campaign")


# Names of the step columns in the summary row of each funnel.
SUMMARY_COLUMNS = {
    "Loans": ("loans_apply", "loans_sub_id", "loans_open_acc", "loans_ssn", "loans_check_limit", "loans_completed"),
    "Registration": ("reg_apply", "reg_sub_id", "reg_phone", "reg_kyc", "reg_completed"),
}


def funnel_summary(events: DataFrame, as_of, days: int = 30, specs: tuple[Funnel, ...] = (LOANS, REGISTRATION)) -> DataFrame:
    """One row per funnel with users counted once over the whole window, from a single scan.

    Both funnels share one pass over the users: a step condition carries its funnel's population.
    """
    recent = events.where(F.col("event_date") >= F.date_sub(F.lit(as_of), days))
    conditions = {
        column: f"{spec.population()} AND {step.condition()}"
        for spec in specs
        for column, step in zip(SUMMARY_COLUMNS[spec.name], spec.steps)
    }
    totals = distinct_counts(recent, {}, [Distinct("user_pseudo_id", conditions)])
    rows = F.array(
        *[
            F.struct(
                F.lit(spec.name).alias("funnel_type"),
                F.to_date(F.date_trunc("month", F.lit(as_of))).alias("period_start"),
                *[
                    (F.col(column) if column in SUMMARY_COLUMNS[spec.name] else F.lit(None).cast("bigint")).alias(column)
                    for column in conditions
                ],
            )
            for spec in specs
        ]
    )
    return totals.select(F.inline(rows))


def long_form(wide: DataFrame, steps: dict[str, str], keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per step of a wide count row, with the share of the previous and of the first step.

    ``steps`` maps count columns to stage labels, in order.
    """
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("stage"), F.lit(label).alias("stage_name"), F.col(column).cast("bigint").alias("users"))
            for n, (column, label) in enumerate(steps.items(), start=1)
        ]
    )
    stages = wide.select(*keys, F.inline(rows))
    # The partitions hold one row per stage of an already aggregated key.
    order = Window.partitionBy(*keys).orderBy("stage") if keys else Window.partitionBy(F.lit(1)).orderBy("stage")
    return stages.select(
        *keys,
        "stage",
        "stage_name",
        "users",
        ratio(F.col("users"), F.lag("users").over(order), 100).alias("pct_of_previous"),
        ratio(F.col("users"), F.first("users").over(order), 100).alias("pct_of_total"),
    )
