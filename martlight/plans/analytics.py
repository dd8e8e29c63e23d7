"""Reports that combine web, spend, bank, target and budget data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlight.functions.classify import is_paid
from martlight.functions.columns import date_bucket, ratio
from martlight.operators.funnels import long_form
from martlight.operators.series import dense_days, period_overlay, share

# Every join below is between frames already aggregated to a report grain (day, channel, campaign, product).


def _full_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "full")


def website_and_bank(sessions: DataFrame, conversions: DataFrame, bank: DataFrame, keys: tuple[str, ...] = ("channel_group",)) -> DataFrame:
    """Sessions and registrations next to bank outcomes.

    Each side is aggregated to (date, channel) before the full join, so no row is counted twice.
    """
    grain = ["date", "channel_group"]
    web = sessions.groupBy(*grain).agg(F.sum("sessions").alias("sessions"))
    registered = conversions.groupBy(*grain).agg(F.sum("registrations").alias("registrations"))
    outcome = bank.groupBy(*grain).agg(F.sum("loan_count").alias("actual_loans"), F.sum("total_revenue_amd").alias("revenue"))
    joined = _full_join(_full_join(web, registered, grain), outcome, grain)
    measures = ("sessions", "registrations", "actual_loans", "revenue")
    return joined.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def spend_and_conversions(spend: DataFrame, sessions: DataFrame, conversions: DataFrame) -> DataFrame:
    """Cost per registration and per session by day and channel; spend belongs to the same day's channel."""
    grain = ["date", "channel_group"]
    cost = spend.groupBy(*grain).agg(F.sum("spend_usd").alias("spend_usd"))
    web = sessions.groupBy(*grain).agg(F.sum("sessions").alias("sessions"))
    registered = conversions.groupBy(*grain).agg(F.sum("registrations").alias("registrations"))
    joined = _full_join(_full_join(cost, web, grain), registered, grain)
    return joined.select(
        *grain,
        "spend_usd",
        "sessions",
        "registrations",
        ratio(F.col("spend_usd"), F.col("registrations")).alias("cost_per_registration"),
        ratio(F.col("spend_usd"), F.col("sessions")).alias("cost_per_session"),
    )


LOAN_STAGES = {
    "loans_pageview": "Page Views",
    "loans_apply_click": "Apply Click",
    "loans_sub_id": "Sub ID",
    "loans_check_limit": "Check Limit",
    "loans_phone_submit": "Phone",
    "loans_otp_submit": "OTP",
    "bank_approved": "Bank Approved",
}


def loans_funnel_to_bank(conversions: DataFrame, bank: DataFrame) -> DataFrame:
    """The loans funnel from page view to the loan the bank issued, with the loan amount on the last stage."""
    web = conversions.agg(*[F.sum(c).alias(c) for c in LOAN_STAGES if c != "bank_approved"])
    issued = bank.agg(F.sum("loan_count").alias("bank_approved"), F.sum("loan_amount").alias("loan_amount"))
    stages = long_form(web.crossJoin(issued), LOAN_STAGES, ("loan_amount",))
    last = F.col("stage_name") == "Bank Approved"
    return stages.withColumn("loan_amount", F.when(last, F.col("loan_amount")))


def funnel_change(conversions: DataFrame, stages: tuple[str, ...]) -> DataFrame:
    """Week-over-week change of every stage of a funnel, long form."""
    weekly = conversions.groupBy(date_bucket(F.col("date"), "week").alias("week_start")).agg(
        *[F.sum(c).alias(c) for c in stages]
    )
    weekly = dense_days(weekly, stages, time="week_start", step="7 days")  # a week without rows has no users
    rows = F.array(*[F.struct(F.lit(c).alias("stage_name"), F.col(c).alias("users")) for c in stages])
    long = weekly.select("week_start", F.inline(rows))
    previous = F.lag("users").over(Window.partitionBy("stage_name").orderBy("week_start"))
    return long.select(
        "week_start",
        "stage_name",
        "users",
        previous.alias("previous"),
        ratio(F.col("users") - previous, previous, 100).alias("change_pct"),
    )


def month_kpis(applications: DataFrame, spend: DataFrame, codes: DataFrame, usd_to_amd: float) -> DataFrame:
    """Actual KPI values per month, channel code and product, long form.

    Levels: all/all, all/product, channel/all and channel/product, those targets exist for. One pass per input
    with grouping sets instead of one query per level. Spend has no product; spend without applications stays.
    """
    apps = applications.select(
        date_bucket(F.col("apply_date"), "month").alias("period"),
        F.col("apply_channel").alias("channel"),
        F.col("product_type").alias("product"),
        F.when(F.col("status") == "approved", 1).otherwise(0).alias("_approved"),
        "revenue_amd",
    )
    levels = [["period"], ["period", "product"], ["period", "channel"], ["period", "channel", "product"]]
    outcome = apps.groupingSets(levels, "period", "channel", "product").agg(
        F.when(F.grouping("channel") == 1, "all").otherwise(F.col("channel")).alias("channel_code"),
        F.when(F.grouping("product") == 1, "all").otherwise(F.col("product")).alias("product_code"),
        F.sum("revenue_amd").alias("revenue"),
        F.sum("_approved").alias("approved"),
        F.count(F.lit(1)).alias("applied"),
    )
    outcome = outcome.select("period", "channel_code", "product_code", "revenue", "approved", "applied")
    coded = spend.join(F.broadcast(codes), "channel_group", "left").select(
        date_bucket(F.col("date"), "month").alias("period"), F.col("channel_code").alias("channel"), "spend_usd"
    )
    cost = coded.groupingSets([["period"], ["period", "channel"]], "period", "channel").agg(
        F.when(F.grouping("channel") == 1, "all").otherwise(F.col("channel")).alias("channel_code"),
        F.sum("spend_usd").alias("spend_usd"),
    )
    cost = cost.select("period", "channel_code", F.lit("all").alias("product_code"), "spend_usd")
    joined = outcome.join(cost, ["period", "channel_code", "product_code"], "full")
    values = {
        "revenue": F.col("revenue"),
        "approved": F.col("approved").cast("double"),
        "cpa": ratio(F.col("spend_usd"), F.col("approved")),
        "roas": ratio(F.col("revenue"), F.col("spend_usd") * F.lit(usd_to_amd)),
        "approval_rate": ratio(F.col("approved"), F.col("applied"), 100),
    }
    rows = F.array(*[F.struct(F.lit(name).alias("metric"), value.alias("actual")) for name, value in values.items()])
    return joined.select("period", F.col("channel_code").alias("channel"), F.col("product_code").alias("product"), F.inline(rows))


def kpis_against_targets(kpis: DataFrame, targets: DataFrame) -> DataFrame:
    """Actual, target and variance in percent for every target row; the ``all`` rows match the totals."""
    keys = ["period", "metric", "channel", "product"]
    joined = targets.select(*keys, "target_value").join(kpis, keys, "left")
    return joined.select(
        *keys,
        "target_value",
        "actual",
        ratio(F.col("actual") - F.col("target_value"), F.col("target_value"), 100).alias("variance_pct"),
    )


def spend_pacing(spend: DataFrame, budgets: DataFrame, codes: DataFrame, as_of: date) -> DataFrame:
    """Budget, spent, remaining, days left and needed against current daily rate for the month of ``as_of``.

    ``as_of`` is the first day without data; the month counts as run up to the day before it.
    """
    today = F.lit(as_of)
    yesterday = F.date_sub(today, 1)
    month = F.to_date(F.date_trunc("month", yesterday))
    in_month = (F.col("date") >= month) & (F.col("date") <= yesterday)
    spent = (
        spend.where(in_month)
        .groupBy("channel_group")
        .agg(F.sum("spend_usd").alias("spent_usd"))
        .join(F.broadcast(codes), "channel_group")
        .select(F.col("channel_code").alias("channel"), "spent_usd")
    )
    rows = budgets.where(F.col("period") == month).join(spent, "channel", "left").withColumn(
        "spent_usd", F.coalesce("spent_usd", F.lit(0.0))
    )
    days = F.dayofmonth(F.last_day(yesterday))
    run_days = F.dayofmonth(yesterday)
    budget, spent_usd = F.col("monthly_budget_usd"), F.col("spent_usd")
    expected = budget * run_days / days
    return rows.select(
        "period",
        "channel",
        budget,
        "daily_budget_usd",
        spent_usd,
        (budget - spent_usd).alias("remaining_usd"),
        (days - run_days).alias("days_left"),
        ratio(budget - spent_usd, days - run_days).alias("needed_daily_usd"),
        (spent_usd / run_days).alias("current_daily_usd"),
        ratio(spent_usd, budget, 100).alias("spent_pct"),
        ratio(spent_usd, expected, 100).alias("pacing_pct"),
    )


def channel_scorecard(bank: DataFrame, spend: DataFrame, usd_to_amd: float) -> DataFrame:
    """Revenue, approved, spend, CPA and ROAS per channel, with a paid subtotal and a grand total."""
    outcome = bank.groupBy("channel_group").agg(
        F.sum("total_revenue_amd").alias("revenue"),
        F.sum(F.col("loan_count") + F.col("card_count") + F.col("deposit_count")).alias("approved"),
    )
    cost = spend.groupBy("channel_group").agg(F.sum("spend_usd").alias("spend_usd"))
    channels = _full_join(outcome, cost, ["channel_group"]).withColumn("paid", is_paid(F.col("channel_group")))
    totals = channels.groupingSets([["channel_group", "paid"], ["paid"], []], "channel_group", "paid").agg(
        F.grouping("channel_group").alias("_by_channel"),
        F.grouping("paid").alias("_by_paid"),
        F.sum("revenue").alias("revenue"),
        F.sum("approved").alias("approved"),
        F.sum("spend_usd").alias("spend_usd"),
    )
    level = (
        F.when(F.col("_by_channel") == 0, "channel").when(F.col("_by_paid") == 0, "subtotal").otherwise("total")
    )
    label = (
        F.when(F.col("_by_channel") == 0, F.col("channel_group"))
        .when(F.col("_by_paid") == 1, "Grand Total")
        .otherwise("Paid Total")
    )
    kept = (F.col("_by_channel") == 0) | (F.col("_by_paid") == 1) | F.col("paid")
    return totals.where(kept).select(
        level.alias("level"),
        label.alias("channel_group"),
        "revenue",
        "approved",
        "spend_usd",
        ratio(F.col("spend_usd"), F.col("approved")).alias("cpa_usd"),
        ratio(F.col("revenue"), F.col("spend_usd") * F.lit(usd_to_amd)).alias("roas"),
    )


def scorecard_against_targets(scorecard: DataFrame, targets: DataFrame, codes: DataFrame, period: date) -> DataFrame:
    """The scorecard with the targets of CPA and ROAS of a month and the distance from them, in percent.

    Targets name channels by code; the one for all channels belongs to the grand total.
    """
    wanted = targets.where((F.col("period") == F.lit(period)) & (F.col("product") == "all") & F.col("metric").isin("cpa", "roas"))
    named = wanted.join(codes.withColumnRenamed("channel_group", "_group"), F.col("channel") == F.col("channel_code"), "left")
    label = F.when(F.col("channel") == "all", "Grand Total").otherwise(F.col("_group"))
    per_channel = named.groupBy(label.alias("channel_group")).agg(
        F.max(F.when(F.col("metric") == "cpa", F.col("target_value"))).alias("cpa_target_usd"),
        F.max(F.when(F.col("metric") == "roas", F.col("target_value"))).alias("roas_target"),
    )
    joined = scorecard.join(per_channel, "channel_group", "left")
    return joined.select(
        *scorecard.columns, "cpa_target_usd", "roas_target",
        ratio(F.col("cpa_usd") - F.col("cpa_target_usd"), F.col("cpa_target_usd"), 100).alias("cpa_vs_target_pct"),
        ratio(F.col("roas") - F.col("roas_target"), F.col("roas_target"), 100).alias("roas_vs_target_pct"),
    )


def campaign_results(bank: DataFrame, spend: DataFrame) -> DataFrame:
    """Revenue, approved products and spend per campaign and channel."""
    keys = ["campaign", "channel_group"]
    outcome = bank.groupBy(F.col("acquired_campaign").alias("campaign"), "channel_group").agg(
        F.sum("total_revenue_amd").alias("revenue"),
        F.sum(F.col("loan_count") + F.col("card_count") + F.col("deposit_count")).alias("approved"),
    )
    cost = spend.groupBy(*keys).agg(F.sum("spend_usd").alias("spend_usd"))
    joined = _full_join(outcome, cost, keys)
    return joined.withColumn("cpa_usd", ratio(F.col("spend_usd"), F.col("approved")))


def top_campaigns_against_average(campaigns: DataFrame, top: int = 10) -> DataFrame:
    """The campaigns with most revenue and their CPA against the average over all paid campaigns."""
    average = campaigns.where(F.col("spend_usd").isNotNull()).agg(
        ratio(F.sum("spend_usd"), F.sum("approved")).alias("avg_cpa_usd")
    )
    best = campaigns.orderBy(F.col("revenue").desc(), "campaign", "channel_group").limit(top)
    return best.crossJoin(F.broadcast(average)).select(
        "campaign",
        "channel_group",
        "revenue",
        "approved",
        "cpa_usd",
        "avg_cpa_usd",
        ratio(F.col("cpa_usd") - F.col("avg_cpa_usd"), F.col("avg_cpa_usd"), 100).alias("vs_avg_cpa_pct"),
    )


def campaign_quadrants(campaigns: DataFrame) -> DataFrame:
    """Paid campaigns as high or low volume and CPA; the medians are the borders."""
    paid = campaigns.where(F.col("cpa_usd").isNotNull())
    borders = paid.agg(
        F.percentile_approx("approved", 0.5, 10_000).alias("volume_border"),
        F.percentile_approx("cpa_usd", 0.5, 10_000).alias("cpa_border"),
    )
    volume = F.when(F.col("approved") >= F.col("volume_border"), "high volume").otherwise("low volume")
    cost = F.when(F.col("cpa_usd") >= F.col("cpa_border"), "high CPA").otherwise("low CPA")
    return paid.crossJoin(F.broadcast(borders)).select(
        "campaign", "channel_group", "approved", "cpa_usd", F.concat_ws(" / ", volume, cost).alias("quadrant")
    )


def cohort_table(applications: DataFrame, as_of: date, mature_days: int = 14) -> DataFrame:
    """Applications by week of application: applied, approved, pending, approval rate, days to approval.

    A cohort is maturing while it has pending applications and its week is recent.
    """
    week = date_bucket(F.col("apply_date"), "week").alias("cohort_week")
    approved = F.col("status") == "approved"
    days = F.date_diff("approval_date", "apply_date")
    rows = applications.groupBy(week).agg(
        F.count(F.lit(1)).alias("applies"),
        F.count_if(approved).alias("approved"),
        F.count_if(F.col("status") == "pending").alias("pending"),
        F.sum(F.when(approved, days)).alias("_days"),
        F.count(F.when(approved, days)).alias("_timed"),
    )
    recent = F.date_diff(F.lit(as_of), F.col("cohort_week")) < mature_days
    return rows.select(
        "cohort_week",
        "applies",
        "approved",
        "pending",
        ratio(F.col("approved"), F.col("applies"), 100).alias("approval_pct"),
        ratio(F.col("_days"), F.col("_timed")).alias("avg_days"),
        ((F.col("pending") > 0) & recent).alias("maturing"),
    )


def approval_curve(applications: DataFrame, days: int | None = None) -> DataFrame:
    """Share of each weekly cohort approved within 0..``days`` days of the application, by default to the last approval."""
    cohort = date_bucket(F.col("apply_date"), "week").alias("cohort_week")
    lag = F.when(F.col("status") == "approved", F.date_diff("approval_date", "apply_date")).alias("day")
    per_day = applications.select(cohort, lag).groupBy("cohort_week", "day").agg(F.count(F.lit(1)).alias("n"))
    sizes = per_day.groupBy("cohort_week").agg(F.sum("n").alias("applies"))
    if days is None:  # one row
        last = per_day.agg(F.greatest(F.coalesce(F.max("day"), F.lit(0)), F.lit(0)).alias("last_day"))
        sizes = sizes.crossJoin(F.broadcast(last))
    else:
        sizes = sizes.withColumn("last_day", F.lit(days))
    grid = sizes.select("cohort_week", "applies", F.explode(F.sequence(F.lit(0), F.col("last_day"))).alias("day"))
    found = grid.join(per_day, ["cohort_week", "day"], "left")
    running = Window.partitionBy("cohort_week").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(F.coalesce("n", F.lit(0))).over(running)
    return found.select(
        "cohort_week", "day", total.alias("approved_so_far"), ratio(total, F.col("applies"), 100).alias("approved_pct")
    )


def rate_band(rate: Column) -> Column:
    # Colour bands of conversion rates.
    return F.when(rate > 60, "green").when(rate >= 40, "yellow").when(rate < 40, "red")


def funnel_heat_table(conversions: DataFrame, bank: DataFrame) -> DataFrame:
    """Conversion rates between stages per channel, with their colour band."""
    web = conversions.groupBy("channel_group").agg(
        F.sum(F.col("loans_apply_click") + F.col("cards_deposits_apply_click")).alias("applies"),
        F.sum(F.col("loans_sub_id") + F.col("cards_deposits_sub_id")).alias("sub_ids"),
        F.sum("registrations").alias("registrations"),
    )
    issued = bank.groupBy("channel_group").agg(
        F.sum(F.col("loan_count") + F.col("card_count") + F.col("deposit_count")).alias("approved")
    )
    rates = _full_join(web, issued, ["channel_group"]).select(
        "channel_group",
        ratio(F.col("sub_ids"), F.col("applies"), 100).alias("apply_to_sub_id_pct"),
        ratio(F.col("registrations"), F.col("sub_ids"), 100).alias("sub_id_to_registration_pct"),
        ratio(F.col("approved"), F.col("registrations"), 100).alias("registration_to_approval_pct"),
    )
    stages = ("apply_to_sub_id", "sub_id_to_registration", "registration_to_approval")
    return rates.select("*", *[rate_band(F.col(f"{s}_pct")).alias(f"{s}_band") for s in stages])


def segment_table(sessions: DataFrame, conversions: DataFrame) -> DataFrame:
    """Sessions, users, bounce rate and registrations by device, by user type and by city in one result.

    Missing values are named ``(not set)``. Registrations have no user type, so they are NULL there. The last two
    columns are the distance of bounce rate and registration rate from those of the whole segment, in points. A value
    that only conversions have is a row without sessions.
    """
    unset = F.lit("(not set)")
    segment = (
        F.when(F.grouping("device_category") == 0, "device")
        .when(F.grouping("user_type") == 0, "user type")
        .otherwise("city")
    )
    name = (
        F.when(F.grouping("device_category") == 0, F.coalesce("device_category", unset))
        .when(F.grouping("user_type") == 0, F.coalesce("user_type", unset))
        .otherwise(F.coalesce("city", unset))
    )
    web = sessions.groupingSets(
        [["device_category"], ["user_type"], ["city"]], "device_category", "user_type", "city"
    ).agg(
        segment.alias("segment"),
        name.alias("name"),
        F.sum("sessions").alias("sessions"),
        F.sum("users").alias("users"),
        F.sum("bounced_sessions").alias("_bounced"),
    )
    registered = conversions.groupingSets([["device_category"], ["city"]], "device_category", "city").agg(
        F.when(F.grouping("device_category") == 0, "device").otherwise("city").alias("segment"),
        F.when(F.grouping("device_category") == 0, F.coalesce("device_category", unset))
        .otherwise(F.coalesce("city", unset))
        .alias("name"),
        F.sum("registrations").alias("registrations"),
    )
    joined = web.select("segment", "name", "sessions", "users", "_bounced").join(
        registered.select("segment", "name", "registrations"), ["segment", "name"], "full"
    )
    whole = Window.partitionBy("segment")
    bounce = ratio(F.col("_bounced"), F.col("sessions"), 100)
    rate = ratio(F.col("registrations"), F.col("sessions"), 100)
    return joined.select(
        "segment",
        "name",
        "sessions",
        share("sessions", ("segment",)).alias("sessions_pct"),
        "users",
        bounce.alias("bounce_rate_pct"),
        "registrations",
        (bounce - ratio(F.sum("_bounced").over(whole), F.sum("sessions").over(whole), 100)).alias("bounce_vs_avg"),
        (rate - ratio(F.sum("registrations").over(whole), F.sum("sessions").over(whole), 100)).alias("registration_rate_vs_avg"),
    )


def device_trend(sessions: DataFrame) -> DataFrame:
    daily = sessions.groupBy("date", "device_category").agg(F.sum("sessions").alias("sessions"))
    return daily.withColumn("share_pct", share("sessions", ("date",)))


def customer_revenue_by_product(bank: DataFrame) -> DataFrame:
    """Revenue of new and existing customers as parts of each product's revenue."""
    rows = bank.groupBy("product_category", "is_existing_customer").agg(F.sum("total_revenue_amd").alias("revenue"))
    return rows.withColumn("share_pct", share("revenue", ("product_category",)))


def paid_organic_split(sessions: DataFrame, bank: DataFrame) -> DataFrame:
    """Sessions, approved products and revenue of paid and other channels, with their shares."""
    paid = F.when(is_paid(F.col("channel_group")), "Paid").otherwise("Organic/Direct").alias("traffic")
    web = sessions.groupBy(paid).agg(F.sum("sessions").alias("sessions"))
    outcome = bank.groupBy(paid).agg(
        F.sum(F.col("loan_count") + F.col("card_count") + F.col("deposit_count")).alias("approved"),
        F.sum("total_revenue_amd").alias("revenue"),
    )
    joined = _full_join(web, outcome, ["traffic"])
    return joined.select(
        "traffic",
        *[c for m in ("sessions", "approved", "revenue") for c in (F.col(m), share(m).alias(f"{m}_pct"))],
    )


def revenue_overlay(bank: DataFrame, targets: DataFrame, start: date, days: int) -> DataFrame:
    """Daily revenue and approved products of a period, the period before it, and the month's target per day."""
    daily = bank.groupBy("date").agg(
        F.sum("total_revenue_amd").alias("revenue"),
        F.sum(F.col("loan_count") + F.col("card_count") + F.col("deposit_count")).alias("approved"),
    )
    overlay = period_overlay(daily, ("revenue", "approved"), start, days)
    goal = targets.where((F.col("metric") == "revenue") & (F.col("channel") == "all") & (F.col("product") == "all"))
    goal = goal.select("period", "target_value")
    month = F.to_date(F.date_trunc("month", "date"))
    joined = overlay.join(goal, month == F.col("period"), "left")
    return joined.select(
        *overlay.columns,
        (F.col("target_value") / F.dayofmonth(F.last_day("date"))).alias("target_per_day"),
    )


PRODUCT_CODES = {"Loans": "loan", "Cards": "card", "Deposits": "deposit"}


def product_revenue_against_target(bank: DataFrame, targets: DataFrame) -> DataFrame:
    """Revenue per month and product against its target."""
    code = F.when(F.lit(False), F.lit(""))
    for product, short in PRODUCT_CODES.items():
        code = code.when(F.col("product_category") == product, short)
    actual = bank.select(date_bucket(F.col("date"), "month").alias("period"), code.alias("product"), "total_revenue_amd")
    actual = actual.where(F.col("product").isNotNull()).groupBy("period", "product").agg(
        F.sum("total_revenue_amd").alias("revenue")
    )
    goal = targets.where((F.col("metric") == "revenue") & (F.col("channel") == "all")).select(
        "period", "product", "target_value"
    )
    return actual.join(goal, ["period", "product"], "left").withColumn(
        "variance_pct", ratio(F.col("revenue") - F.col("target_value"), F.col("target_value"), 100)
    )


def hour_pattern(staged: DataFrame) -> DataFrame:
    """Events and page views by day of week and hour."""
    return staged.groupBy(
        F.dayofweek("event_timestamp").alias("day_of_week"), F.hour("event_timestamp").alias("hour")
    ).agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_name") == "page_view").alias("pageviews"))
