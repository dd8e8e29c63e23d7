"""The registered queries: every one runs the engine over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlight.functions.metrics import contract_metrics, session_quality
from martlight.functions.columns import date_bucket
from martlight.operators import alerts, funnels, merge, quality, series, sessions, versions
from martlight.operators.sinks import append_new, create_if_absent, replace_recent, replace_table
from martlight.plans import analytics, bank, charts, dims, facts, spend, staging
from martlight.plans.queryspec import QuerySpec, run
from martlight.plans.refresh import marts_path, read_mart, refresh, register_views, scan_figures
from martlight.session import configure, materialize, work_path
from martlight.sources import readers, schemas
from martlight.sources.literals import dim_product
from martlight.streaming import jobs, windows
from workload import adapters as given

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 3
AS_OF = given.AS_OF


def rounded(df: DataFrame) -> DataFrame:
    """Doubles of aggregates to three digits, so that the order of floating-point sums does not show."""
    return df.select(
        *[F.round(f"`{c}`", DIGITS).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in df.dtypes]
    )


class Inputs:
    """The marts over one folder of given tables, built lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return given.table(self.spark, self.folder, name)

    def staged(self) -> DataFrame:
        return staging.stg_events(given.raw_events(self.spark, self.folder), given.SITE)

    def clean(self, documented: bool = False) -> DataFrame:
        return staging.stg_events_clean(self.staged(), test_users=("u1",), site=given.SITE, documented=documented)

    def sessions(self) -> DataFrame:
        return facts.fact_sessions(self.staged())

    def conversions(self) -> DataFrame:
        return facts.fact_conversions(self.staged())

    def both(self) -> tuple[DataFrame, DataFrame]:
        return facts.both_facts(self.staged())

    def clean_conversions(self) -> DataFrame:
        return facts.fact_conversions(self.clean(), "clean")

    def channels(self) -> DataFrame:
        return dims.dim_channel(dims.channel_pairs(given.raw_events(self.spark, self.folder), given.SITE))

    def google(self) -> DataFrame:
        return spend.fact_ad_spend_google(given.google_ads_stats(self.spark, self.folder))

    def spend(self) -> DataFrame:
        return spend.fact_ad_spend(self.google(), given.meta_insights(self.spark, self.folder))

    def bank_rows(self) -> DataFrame:
        return given.bank_rows(self.spark, self.folder)

    def bank(self) -> DataFrame:
        return bank.fact_bank_conversions(staging.stg_bank_conversions(self.bank_rows()))

    def applications(self) -> DataFrame:
        return given.applications(self.spark, self.folder)

    def targets(self) -> DataFrame:
        return given.targets(self.spark)

    def budgets(self) -> DataFrame:
        return readers.fill_daily_budget(given.budgets(self.spark))

    def codes(self) -> DataFrame:
        return given.codes(self.spark)

    def dataset(self, name: str) -> DataFrame:
        return {
            charts.SESSIONS: self.sessions,
            charts.CONVERSIONS: self.conversions,
            charts.CHANNELS: self.channels,
            charts.BANK: self.bank,
        }[name]()


REGISTRY: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(build: Callable[[Inputs], DataFrame]):
    REGISTRY[build.__name__] = build
    return build


# --- sources, staging, projections -------------------------------------------------------------------------


@query
def stg_events(i):
    return i.staged()


@query
def stg_events_recent(i):
    """Events landed by day, read through the reader, which prunes the days."""
    path = work_path(i.spark, "landed-events")
    given.raw_events(i.spark, i.folder).write.partitionBy("event_date").parquet(path)
    recent = staging.stg_events(readers.events(i.spark, path, since=date(2024, 1, 24), until=date(2024, 1, 30)), given.SITE)
    return recent.groupBy("event_date", "source_clean", "product_category").agg(F.count(F.lit(1)).alias("events"))


@query
def stg_events_clean(i):
    return i.clean().select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id", "event_name_clean", "flow_type", "funnel_step", "is_test_event",
    )


@query
def event_params_strict(i):
    raw = given.raw_events(i.spark, i.folder)
    strict = staging.stg_events(raw, given.SITE, strict=True)
    return strict.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("events"), F.max("session_number").alias("max_number"), F.min("page_title").alias("first_title")
    )


@query
def events_without_tests(i):
    return staging.without_tests(i.clean()).groupBy("event_name").agg(F.count(F.lit(1)).alias("events"))


@query
def events_without_personal_data(i):
    return staging.without_personal_data(i.staged(), salt="fixture").select(
        "event_timestamp", "event_name", "page_location", "page_referrer", "user_hash", "channel_group"
    )


@query
def landing_pages(i):
    pages = i.table("pages").select(staging.landing_page("url").alias("landing_page"), F.length("html").alias("size"))
    return pages.groupBy("landing_page").agg(F.count(F.lit(1)).alias("pages"), F.sum("size").alias("characters"))


@query
def source_channel_matrix(i):
    return i.staged().groupBy("source", "medium", "source_clean", "channel_group").agg(F.count(F.lit(1)).alias("events"))


@query
def product_pages(i):
    return i.staged().groupBy("page_location", "product_category").agg(F.count(F.lit(1)).alias("events"))


@query
def stg_bank_applications(i):
    raw = given.bank_applications(i.spark, i.folder)
    return staging.stg_bank_applications(raw).drop("uploaded_at")


@query
def stg_bank_conversions(i):
    rows = i.bank_rows().drop("event_time_raw")
    doubled = rows.unionByName(rows.where(F.col("card_count") > 0)).withColumn(
        "token_id", F.when(~F.col("token_id").endswith("13"), F.col("token_id"))
    )
    return rounded(staging.stg_bank_conversions(doubled))


@query
def bank_export_load(i):
    """Orders written as an export in CSV, read back through encoding detection and cleaning."""
    path = work_path(i.spark, "export")
    given.bank_export(i.bank_rows()).write.option("header", True).csv(path)
    frame = bank.check_headers(bank.read_export(i.spark, path))
    return rounded(bank.clean_export(frame, given.LOADED_AT))


@query
def bank_export_checks(i):
    doubled = i.bank_rows().unionByName(i.bank_rows().where(F.col("loan_count") > 0))
    return bank.export_checks(given.bank_export(doubled))


@query
def bank_export_checks_damaged(i):
    """The checks before a load on an export with every kind of damage."""
    return bank.export_checks(given.damaged_export(i.bank_rows().unionByName(i.bank_rows().where(F.col("loan_count") > 0))).drop("LOAN_COUNT"))


def _damaged_load(i):
    """The warehouse after the load of a damaged export, whose files follow each other in the order of the tokens."""
    warehouse, path = work_path(i.spark, "bank-warehouse"), work_path(i.spark, "damaged")
    number = F.substring("Event Param Value (String)", 2, 20).try_cast("long")
    # The number is a column, since comparisons in a sort compute an expression again, which is slow where it is no number.
    export = given.damaged_export(i.bank_rows(), named=True).withColumn("_number", number)
    export.orderBy(F.col("_number").asc_nulls_last(), "Client_code").drop("_number").write.option("header", True).csv(path)
    bank.load_bank(i.spark, path, warehouse, given.LOADED_AT, max_rejected=0.2)
    return warehouse


@query
def bank_load_rejects(i):
    """The refused rows of a damaged export: record, counted over its files, reason, and what they had."""
    stored = i.spark.read.schema(bank.REJECTS).parquet(f"{_damaged_load(i)}/rejects/bank_conversions")
    return stored.select(F.col("position").alias("record"), "reason", "event_date_text", "token_id", "client_code")


@query
def bank_load_accepted(i):
    """The fact after the load of a damaged export: its other rows."""
    return rounded(i.spark.read.parquet(marts_path(_damaged_load(i), "fact_bank_conversions")))


@query
def approvals_csv(i):
    """Applications through the approvals CSV template."""
    path = work_path(i.spark, "approvals")
    rows = i.applications().select("application_id", "product_type", "apply_date", "apply_source", "status", "approval_date", "revenue_amd")
    rows.write.option("header", True).csv(path)
    return rounded(readers.approvals(i.spark, path))


@query
def monthly_targets_csv(i):
    """Targets per month and product, written as the template and read back."""
    path = work_path(i.spark, "targets")
    rows = i.applications().groupBy(date_bucket(F.col("apply_date"), "month").alias("period"), F.col("product_type").alias("product"))
    rows = rows.agg(F.round(F.sum("revenue_amd")).alias("target_value"))
    rows.selectExpr("period", "'revenue' AS metric", "'all' AS channel", "product", "target_value").write.option("header", True).csv(path)
    return rounded(readers.monthly_targets(i.spark, path))


@query
def monthly_budgets_csv(i):
    """Budgets per month and channel, written as the template without most daily budgets and read back."""
    path = work_path(i.spark, "budgets")
    spent = given.landed_spend(i.spark, i.folder)
    rows = spent.groupBy(date_bucket(F.col("date"), "month").alias("period"), "channel").agg(F.round(F.sum("cost")).alias("monthly_budget_usd"))
    rows = rows.withColumn("daily_budget_usd", F.when(F.col("channel") == "linkedin", F.round(F.col("monthly_budget_usd") / 30)))
    rows.write.option("header", True).csv(path)
    return rounded(readers.monthly_budgets(i.spark, path))


@query
def uploads_tsv(i):
    """Landed spend through the upload reader, as tab-separated text."""
    path = work_path(i.spark, "upload")
    rows = given.landed_spend(i.spark, i.folder)
    rows.write.option("header", True).option("sep", "\t").csv(path)
    upload = readers.upload(i.spark, path, "tsv", schemas.AD_SPEND)
    return rounded(
        upload.groupBy("date", "channel", "currency").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("impressions").alias("impressions"), F.sum("cost").alias("cost")
        )
    )


def _uploaded(i, kind: str):
    path, rows = work_path(i.spark, f"upload-{kind}"), given.landed_spend(i.spark, i.folder)
    writer = rows.write.option("header", True)
    writer.csv(path) if kind == "csv" else writer.parquet(path)
    upload = readers.upload(i.spark, path, kind, schemas.AD_SPEND)
    return rounded(
        upload.groupBy("date", "channel", "currency").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("impressions").alias("impressions"), F.sum("cost").alias("cost")
        )
    )


@query
def uploads_csv(i):
    return _uploaded(i, "csv")


@query
def uploads_parquet(i):
    return _uploaded(i, "parquet")


@query
def raw_ad_spend_landed(i):
    """Landed spend through its reader: one drop has its dates as numbers and its figures as text."""
    return spend.raw_spend(readers.ad_spend(i.spark, given.spend_drops(i.spark, i.folder, work_path(i.spark, "spend-drops"))))


@query
def google_ads_landed(i):
    """Campaign statistics landed by day, read from a day on."""
    path = work_path(i.spark, "google")
    stats = given.google_ads_stats(i.spark, i.folder).withColumn("clicks", F.col("clicks").cast("int"))
    stats.repartition("data_date").write.partitionBy("data_date").parquet(path)
    return spend.fact_ad_spend_google(readers.google_ads_stats(i.spark, path, since=date(2024, 1, 11)))


@query
def meta_insights_landed(i):
    """Insights of two drops, one with all figures as text, some of them unreadable."""
    return spend.fact_ad_spend_meta(readers.meta_insights(i.spark, given.insight_drops(i.spark, i.folder, work_path(i.spark, "meta-drops"))))


@query
def lost_values(i):
    """How many values of each field of the landed insights do not fit."""
    return readers.lost_values(i.spark, given.insight_drops(i.spark, i.folder, work_path(i.spark, "meta-drops")), schemas.META_INSIGHTS)


@query
def manual_ad_spend(i):
    """Manual spend files; missing local amounts are filled from USD."""
    path = work_path(i.spark, "manual")
    rows = i.spend().select(
        "date", F.col("channel_group").alias("channel"), "campaign", F.col("ad_group").alias("adset"),
        F.lit("").alias("creative"), F.col("impressions").cast("bigint").alias("impressions"),
        F.col("clicks").cast("bigint").alias("clicks"), "spend_usd",
        F.when(F.col("channel_group") == "Meta Ads", F.col("spend_amd")).alias("spend_amd"),
    )
    rows.write.option("header", True).csv(path)
    spent = readers.manual_ad_spend(i.spark, path)
    return rounded(
        spent.groupBy("channel", "adset").agg(
            F.sum("clicks").alias("clicks"), F.sum("spend_usd").alias("spend_usd"), F.sum("spend_amd").alias("spend_amd")
        )
    )


# --- dimensions and star joins ------------------------------------------------------------------------------


@query
def dim_date(i):
    """Calendar over the span of the orders, with the orders of each day."""
    days = i.table("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("orders"))
    span = days.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    calendar = dims.dim_date(i.spark, F.col("a"), F.col("b"), bounds=span)
    return calendar.join(days, "date", "left").select(*calendar.columns, F.coalesce("orders", F.lit(0)).alias("orders"))


@query
def dim_channel(i):
    return i.channels()


@query
def product_traffic(i):
    """Session fact joined to the product dimension."""
    joined = dims.with_product(i.sessions(), dim_product(i.spark))
    return joined.groupBy("product_key", "product_group", "product_category", "has_funnel").agg(
        F.sum("sessions").alias("sessions"), F.sum("pageviews").alias("pageviews")
    )


@query
def channel_traffic(i):
    """Session fact joined to the channel dimension on its whole key."""
    joined = dims.with_channel(i.sessions(), i.channels())
    return joined.groupBy("channel_key", "channel_type", "is_paid", "channel_category").agg(F.sum("sessions").alias("sessions"))


@query
def weekend_traffic(i):
    """Session fact joined to the calendar."""
    fact = i.sessions().withColumnRenamed("date", "fact_date").withColumnRenamed("fact_date", "date")
    calendar = dims.dim_date(i.spark, date(2024, 1, 1), date(2024, 12, 31))
    joined = dims.with_calendar(fact, calendar)
    return joined.groupBy("week_start", "is_weekend", "is_holiday").agg(F.sum("sessions").alias("sessions"))


# --- facts and funnels --------------------------------------------------------------------------------------


@query
def fact_sessions(i):
    return i.sessions()


@query
def session_rollup(i):
    return facts.session_rollup(i.staged())


@query
def fact_conversions(i):
    return i.conversions()


@query
def fact_conversions_clean(i):
    return i.clean_conversions()


@query
def funnel_loans(i):
    return funnels.funnel(i.clean(), funnels.LOANS)


@query
def funnel_registration(i):
    return funnels.funnel(i.clean(), funnels.REGISTRATION)


@query
def funnel_summary(i):
    return funnels.funnel_summary(i.clean(), AS_OF)


@query
def funnel_loans_documented(i):
    return funnels.documented_funnel(i.clean(documented=True), funnels.DOCUMENTED_LOANS)


@query
def funnel_registration_documented(i):
    return funnels.documented_funnel(i.clean(documented=True), funnels.DOCUMENTED_REGISTRATION)


@query
def funnel_step_rates(i):
    """Loans funnel over all days, long form with step rates."""
    steps = {s.name: s.name for s in funnels.LOANS.steps}
    totals = funnels.funnel(i.clean(), funnels.Funnel("Loans", ("Consumer Loans",), "Sprint", ("channel_group",), funnels.LOANS.steps))
    return rounded(funnels.long_form(totals, steps, ("channel_group",)))


# --- spend and bank -----------------------------------------------------------------------------------------


@query
def fact_ad_spend_google(i):
    return i.google()


@query
def fact_ad_spend_meta(i):
    return spend.fact_ad_spend_meta(given.meta_insights(i.spark, i.folder))


@query
def fact_ad_spend(i):
    return i.spend()


@query
def raw_ad_spend(i):
    return spend.raw_spend(given.landed_spend(i.spark, i.folder))


@query
def spend_by_campaign(i):
    spec = QuerySpec(
        "fact_ad_spend",
        ("impressions", "clicks", "spend_usd", "spend_amd", "ctr_pct", "cpc_usd", "cpm_usd", "avg_cost_per_conversion"),
        ("campaign", "channel_group"),
    )
    return rounded(run(spec, i.spend()))


@query
def spend_last_90_days(i):
    spec = QuerySpec(
        "fact_ad_spend", ("spend_usd",), ("channel_group",), filters=(("date", ">=", date(2023, 11, 2)),), grain="P1W"
    )
    return rounded(run(spec, i.spend()))


@query
def fact_bank_conversions(i):
    return rounded(i.bank())


@query
def bank_load_totals(i):
    return bank.load_totals(i.bank())


@query
def bank_merge(i):
    rows = i.bank_rows()
    merged = merge.upsert(given.merge_target(rows), given.merge_source(rows))
    return rounded(
        merged.select("token_id", "client_code", "event_date", *merge.UPDATED, "acquired_source", "_action").withColumnRenamed("_action", "action")
    )


@query
def bank_merge_counts(i):
    rows = i.bank_rows()
    return merge.action_counts(merge.upsert(given.merge_target(rows), given.merge_source(rows)))


@query
def bank_merge_table(i):
    """The merge written onto a stored table, partition by partition, then read back."""
    path = work_path(i.spark, "bank-table")
    rows = i.bank_rows()
    merge.merge_into(i.spark, path, given.merge_target(rows), schemas.BANK_CONVERSIONS)
    merge.merge_into(i.spark, path, given.merge_source(rows), schemas.BANK_CONVERSIONS)
    stored = i.spark.read.schema(schemas.BANK_CONVERSIONS).parquet(path)
    return rounded(stored.select("token_id", "client_code", "event_date", *merge.UPDATED))


def _pruned(i):
    path, rows = work_path(i.spark, "bank-buckets"), i.bank_rows()
    late = given.merge_source(rows).where(F.col("token_id").endswith("55"))
    merge.merge_into_buckets(i.spark, path, given.merge_target(rows), schemas.BANK_CONVERSIONS, 8)
    return path, merge.merge_into_buckets(i.spark, path, late, schemas.BANK_CONVERSIONS, 8)


@query
def bank_merge_pruned(i):
    """A few late rows merged into a table whose days are cut by key, then the table."""
    stored = i.spark.read.schema(schemas.BANK_CONVERSIONS).parquet(_pruned(i)[0])
    return rounded(stored.select("token_id", "client_code", "event_date", *merge.UPDATED))


@query
def bank_merge_pruned_bytes(i):
    """Rows of the merge, and whether it replaced fewer bytes than the touched days have."""
    got = _pruned(i)[1]
    source = given.merge_source(i.bank_rows()).where(F.col("token_id").endswith("55")).select("token_id").distinct()
    return source.agg(
        F.count(F.lit(1)).alias("source_keys"), F.lit(got["updated"]).cast("long").alias("updated"), F.lit(got["added"]).cast("long").alias("added"),
        F.lit(0 < got["bytes"] < got["day_bytes"]).alias("fewer_bytes"),
    )


@query
def bank_load(i):
    """Two loads of exports into one warehouse, the second overlapping the first; the files differ in encoding and date form."""
    rows, warehouse = i.bank_rows(), work_path(i.spark, "bank-warehouse")
    for name, part in (("first", given.merge_target(rows)), ("second", given.merge_source(rows))):
        exports = given.mixed_exports(part, work_path(i.spark, f"exports-{name}"))
        bank.load_bank(i.spark, exports, warehouse, given.LOADED_AT)
    return rounded(i.spark.read.parquet(marts_path(warehouse, "fact_bank_conversions")))


@query
def bank_insert_if_absent(i):
    rows = i.bank_rows()
    new = merge.insert_if_absent(given.merge_target(rows), rows, ("token_id",))
    return rounded(new.select("token_id", "client_code", "event_date", "loan_amount"))


# --- dashboard charts ---------------------------------------------------------------------------------------


def _chart(name: str):
    def build(i: Inputs) -> DataFrame:
        spec = charts.CHARTS[name]
        return rounded(charts.chart(name, {spec.dataset: i.dataset(spec.dataset)}, AS_OF))

    return build


for _name in charts.CHARTS:
    REGISTRY[f"chart_{_name}"] = _chart(_name)


# --- combined reports ---------------------------------------------------------------------------------------


@query
def website_and_bank(i):
    return rounded(analytics.website_and_bank(*i.both(), i.bank()))


@query
def spend_and_conversions(i):
    return rounded(analytics.spend_and_conversions(i.spend(), *i.both()))


@query
def loans_funnel_to_bank(i):
    return rounded(analytics.loans_funnel_to_bank(i.conversions(), i.bank()))


@query
def funnel_week_change(i):
    stages = charts.LOAN_STAGES
    return rounded(analytics.funnel_change(i.conversions(), stages))


@query
def funnel_cards_week_change(i):
    return rounded(analytics.funnel_change(i.conversions(), charts.CARD_STAGES))


@query
def channel_overlay(i):
    """Sessions of each channel and day next to those of the period before."""
    daily = i.sessions().groupBy("date", "channel_group").agg(F.sum("sessions").alias("sessions"))
    return series.period_overlay(daily, ("sessions",), date(2024, 1, 16), 15, keys=("channel_group",))


def _kpis(i):
    return analytics.month_kpis(i.applications(), i.spend(), i.codes(), readers.USD_TO_AMD)


@query
def month_kpis(i):
    return rounded(_kpis(i))


@query
def kpis_against_targets(i):
    return rounded(analytics.kpis_against_targets(_kpis(i), i.targets()))


@query
def spend_pacing(i):
    return rounded(analytics.spend_pacing(i.spend(), i.budgets(), i.codes(), date(2024, 1, 25)))


@query
def channel_scorecard(i):
    return rounded(analytics.channel_scorecard(i.bank(), i.spend(), readers.USD_TO_AMD))


@query
def channel_scorecard_targets(i):
    card = analytics.channel_scorecard(i.bank(), i.spend(), readers.USD_TO_AMD)
    return rounded(analytics.scorecard_against_targets(card, i.targets(), i.codes(), date(2024, 1, 1)))


@query
def top_campaigns_against_average(i):
    return rounded(analytics.top_campaigns_against_average(analytics.campaign_results(i.bank(), i.spend())))


@query
def campaign_quadrants(i):
    return rounded(analytics.campaign_quadrants(analytics.campaign_results(i.bank(), i.spend())))


@query
def cohort_table(i):
    return rounded(analytics.cohort_table(i.applications(), AS_OF))


@query
def approval_curve(i):
    return rounded(analytics.approval_curve(i.applications()))


@query
def funnel_heat_table(i):
    return rounded(analytics.funnel_heat_table(i.conversions(), i.bank()))


@query
def segment_table(i):
    return rounded(analytics.segment_table(*i.both()))


@query
def device_trend(i):
    return rounded(analytics.device_trend(i.sessions()))


@query
def customer_revenue_by_product(i):
    return rounded(analytics.customer_revenue_by_product(i.bank()))


@query
def paid_organic_split(i):
    return rounded(analytics.paid_organic_split(i.sessions(), i.bank()))


@query
def revenue_overlay(i):
    return rounded(analytics.revenue_overlay(i.bank(), i.targets(), date(2024, 1, 16), 15))


@query
def product_revenue_against_target(i):
    return rounded(analytics.product_revenue_against_target(i.bank(), i.targets()))


@query
def hour_pattern(i):
    return analytics.hour_pattern(i.staged())


# --- metrics and series -------------------------------------------------------------------------------------


@query
def contract_totals(i):
    return rounded(contract_metrics(i.staged()))


@query
def contract_by_channel(i):
    return rounded(contract_metrics(i.staged(), ("channel_group",)))


@query
def session_quality_by_device(i):
    return rounded(session_quality(i.staged(), ("device_category",)))


@query
def weekly_growth(i):
    weekly = run(QuerySpec("fact_sessions", ("sessions",), ("channel_group",), grain="P1W"), i.sessions())
    weekly = weekly.withColumnRenamed("date", "week_start")
    dense = series.dense_days(weekly, ("sessions",), ("channel_group",), "week_start", "7 days")
    return rounded(series.growth(dense, "sessions", ("channel_group",)))


@query
def weighted_session_metrics(i):
    spec = QuerySpec(
        "fact_sessions",
        ("new_users", "pageviews", "pages_per_session", "avg_duration_sec", "weighted_duration_sec"),
        ("product_category", "user_type"),
    )
    return rounded(run(spec, i.sessions()))


@query
def country_filter_chart(i):
    """A dashboard question with the interactive filters: time range, channels, product."""
    spec = QuerySpec(
        "fact_conversions",
        ("total_users", "applies", "sub_ids", "registrations"),
        ("city", "device_category"),
        filters=(
            ("date", "between", (date(2024, 1, 8), date(2024, 1, 21))),
            ("channel_group", "in", ("Meta Ads", "Email", "Direct", "Referral", "Other")),
            ("product_category", "!=", "Other"),
        ),
        order=(("total_users", True),),
    )
    return run(spec, i.conversions())


@query
def inactivity_sessions(i):
    events = i.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rounded(sessions.inactivity_sessions(events, "user_id", "ts"))


@query
def event_session_numbers(i):
    events = i.table("events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    return sessions.assign_sessions(events, "user_id", "ts").select("event_id", "session_no")


# --- quality and alerts -------------------------------------------------------------------------------------


def _refresh_results(i):
    frames = {"fact_sessions": i.sessions(), "fact_conversions": i.conversions(), "dim_channel": i.channels()}
    return reduce(DataFrame.unionByName, [quality.run_checks(frames[t], c) for t, c in quality.refresh_checks(AS_OF).items()])


@query
def refresh_checks(i):
    return rounded(_refresh_results(i))


@query
def refresh_summary(i):
    return quality.summary(_refresh_results(i))


@query
def quality_suite(i):
    frames = {
        "fact_sessions": i.sessions(),
        "fact_conversions": i.conversions(),
        "fact_bank_conversions": i.bank(),
        "dim_channel": i.channels(),
        "dim_product": dim_product(i.spark),
    }
    return rounded(
        reduce(DataFrame.unionByName, [quality.run_checks(frames[t], c) for t, c in quality.suite_checks(AS_OF).items()])
    )


@query
def staging_checks(i):
    return rounded(quality.run_checks(i.staged(), quality.staging_checks(AS_OF)))


@query
def mart_checks(i):
    by_day = i.sessions().groupBy("date").agg(F.sum("sessions").alias("sessions"), F.sum("bounced_sessions").alias("bounced_sessions"))
    return rounded(quality.run_checks(by_day, quality.mart_checks(AS_OF)))


@query
def spend_checks(i):
    return rounded(quality.run_checks(i.spend(), quality.spend_checks(AS_OF)))


@query
def volume_drop(i):
    return rounded(quality.volume_drop(i.sessions()))


@query
def registration_band(i):
    return rounded(quality.registration_band(i.conversions()))


@query
def channel_agreement(i):
    return quality.channel_agreement(i.sessions(), i.bank())


@query
def duplicate_bank_clients(i):
    return quality.duplicate_key_rows(i.bank_rows(), ("event_date", "client_code"))


@query
def duplicate_counts(i):
    return quality.duplicate_keys(i.bank_rows(), ("event_date", "client_code"))


@query
def grain_duplicates(i):
    return quality.duplicate_keys(i.sessions(), (*facts.CONVERSION_KEYS, "user_type"))


@query
def orphan_channels(i):
    """Channels of the bank fact that a dimension without e-mail lacks."""
    known = i.channels().where(F.col("channel_group") != "Email")
    return quality.orphans(i.bank(), known, {"channel_group": "channel_group"})


def _quality_all(i):
    staged = materialize(i.staged(), "staged")
    sessions, conversions = materialize(facts.fact_sessions(staged), "sessions"), materialize(facts.fact_conversions(staged), "conversions")
    channels = i.channels()
    frames = {
        "fact_sessions": sessions, "fact_conversions": conversions, "fact_bank_conversions": i.bank(),
        "dim_channel": channels, "dim_product": dim_product(i.spark), "stg_events": staged, "ad_spend": i.spend(),
    }
    every = [*quality.refresh_checks(AS_OF).items(), *quality.suite_checks(AS_OF).items()]
    every += [("stg_events", quality.staging_checks(AS_OF)), ("ad_spend", quality.spend_checks(AS_OF))]
    grain = (*facts.CONVERSION_KEYS, "user_type")
    relations = quality.relation_checks(sessions, conversions, i.bank(), i.bank_rows(), channels, grain)
    return reduce(DataFrame.unionByName, [quality.run_checks(frames[t], c) for t, c in every], relations)


@query
def quality_all(i):
    """Every check in the common columns."""
    return rounded(_quality_all(i))


@query
def quality_all_summary(i):
    return quality.summary(_quality_all(i))


@query
def alert_levels(i):
    kpis = analytics.kpis_against_targets(_kpis(i), i.targets())
    pacing = analytics.spend_pacing(i.spend(), i.budgets(), i.codes(), date(2024, 1, 25))
    change = analytics.funnel_change(i.conversions(), charts.LOAN_STAGES)
    return rounded(alerts.classify(alerts.deviations(kpis, pacing, change)))


@query
def alert_header(i):
    kpis = analytics.kpis_against_targets(_kpis(i), i.targets())
    pacing = analytics.spend_pacing(i.spend(), i.budgets(), i.codes(), date(2024, 1, 25))
    change = analytics.funnel_change(i.conversions(), charts.LOAN_STAGES)
    return alerts.header(alerts.classify(alerts.deviations(kpis, pacing, change)))


# --- tables, refresh, streams -------------------------------------------------------------------------------


@query
def incremental_sessions(i):
    """The session fact written up to a day, then its last eight days replaced from all events."""
    path = work_path(i.spark, "fact-sessions")
    raw = given.raw_events(i.spark, i.folder)
    early = staging.stg_events(raw, given.SITE, until=date(2024, 1, 26))
    replace_table(facts.fact_sessions(early), path, "date", facts.CLUSTER)
    since = date(2024, 1, 23)
    recent = staging.stg_events(raw, given.SITE, since=since)
    replace_recent(facts.fact_sessions(recent), path, since, "date", facts.CLUSTER)
    return i.spark.read.parquet(path)


@query
def append_new_rows(i):
    """Bank rows appended twice; keys already stored are skipped."""
    path = work_path(i.spark, "appended")
    rows = i.bank_rows().select("token_id", "client_code", "loan_count")
    append_new(rows.where(F.col("loan_count") > 0), path, ("token_id",))
    append_new(rows, path, ("token_id",))
    return i.spark.read.parquet(path)


def _refreshed(i):
    warehouse = work_path(i.spark, "warehouse")
    raw = given.raw_events(i.spark, i.folder)
    outcome = refresh(
        i.spark,
        raw,
        warehouse,
        AS_OF,
        google_stats=given.google_ads_stats(i.spark, i.folder),
        meta_insights=given.meta_insights(i.spark, i.folder),
        site=given.SITE,
        test_users=("u1",),
    )
    return warehouse, outcome


@query
def refresh_status(i):
    """Mode, outcome and rows of every mart of a full refresh."""
    return _refreshed(i)[1].status.drop("error")


@query
def refresh_check_rows(i):
    return rounded(_refreshed(i)[1].checks)


@query
def refresh_incremental(i):
    """The conversion fact after a full refresh up to a day and an incremental one of all events."""
    warehouse, raw = work_path(i.spark, "warehouse"), given.raw_events(i.spark, i.folder)
    early = readers.between_days(raw, None, date(2024, 1, 26))
    for events, as_of, full in ((early, date(2024, 1, 27), True), (raw, AS_OF, False)):
        refresh(i.spark, events, warehouse, as_of, full, site=given.SITE, test_users=("u1",))
    return read_mart(i.spark, warehouse, "fact_conversions")


@query
def refreshed_funnel_summary(i):
    return read_mart(i.spark, _refreshed(i)[0], "funnel_summary")


@query
def table_versions(i):
    """Sessions per day as a reader sees them while a new version is written, after it is published, and by its number."""
    path, raw = work_path(i.spark, "versions"), given.raw_events(i.spark, i.folder)
    versions.replace(facts.fact_sessions(staging.stg_events(raw, given.SITE, until=date(2024, 1, 26))), path, "date", facts.CLUSTER)
    since = date(2024, 1, 23)
    draft = versions.write(facts.fact_sessions(staging.stg_events(raw, given.SITE, since=since)), path, "date", facts.CLUSTER, since)
    seen = {"while written": versions.read(i.spark, path)}
    versions.publish(i.spark, draft)
    seen |= {"published": versions.read(i.spark, path), "the first": versions.read(i.spark, path, 1)}
    days = [f.groupBy("date").agg(F.sum("sessions").alias("sessions")).select(F.lit(name).alias("reader"), "*") for name, f in seen.items()]
    return reduce(DataFrame.unionByName, days)


def _after_bad_spend(i):
    """A full refresh, then one whose Google costs are negative."""
    warehouse, raw = work_path(i.spark, "warehouse"), given.raw_events(i.spark, i.folder)
    google, meta = given.google_ads_stats(i.spark, i.folder), given.meta_insights(i.spark, i.folder)
    bad = google.withColumn("cost_micros", -F.col("cost_micros") - 1)
    for stats in (google, bad):
        outcome = refresh(i.spark, raw, warehouse, AS_OF, google_stats=stats, meta_insights=meta, site=given.SITE, test_users=("u1",))
    return warehouse, outcome


@query
def refresh_published(i):
    """Which marts a refresh has published, and why not."""
    return _after_bad_spend(i)[1].published


@query
def refresh_keeps_bad_spend(i):
    """The spend fact after a refresh whose spend failed its check: the rows of before."""
    spent = read_mart(i.spark, _after_bad_spend(i)[0], "fact_ad_spend")
    return rounded(spent.groupBy("date", "channel_group").agg(F.sum("spend_usd").alias("spend_usd"), F.count(F.lit(1)).alias("rows")))


@query
def refresh_relation_rows(i):
    """The checks of a refresh that compare tables and days."""
    return rounded(_refreshed(i)[1].relations)


@query
def scanned_inputs(i):
    """Files that a scan of landed events reads from a day on, one a day, and whether its bytes fall when the day moves."""
    path = work_path(i.spark, "landed-events")
    given.raw_events(i.spark, i.folder).repartition("event_date").write.partitionBy("event_date").parquet(path)
    starts = (date(2024, 1, 1), date(2024, 1, 10), date(2024, 1, 24))
    figures = [scan_figures(readers.events(i.spark, path, since), f"since {since}") for since in starts]
    rows = reduce(DataFrame.unionByName, figures)
    return rows.select("input", "files", (F.col("bytes") < F.lag("bytes", 1, 1 << 60).over(Window.orderBy("input"))).alias("fewer_bytes"))


@query
def views_report(i):
    """A star join in SQL over the views of a refreshed warehouse."""
    register_views(i.spark, _refreshed(i)[0])
    return i.spark.sql(
        "SELECT channel_type, is_paid, date, sum(sessions) AS sessions FROM fact_sessions JOIN dim_channel USING (source_clean, channel_group) "
        "GROUP BY channel_type, is_paid, date"
    )


@query
def empty_spend_table(i):
    """A table created empty, then again, then filled with landed spend, then created once more."""
    path = work_path(i.spark, "spend")
    for rows in (None, spend.raw_spend(given.landed_spend(i.spark, i.folder)), None):
        create_if_absent(i.spark, path, schemas.FACT_AD_SPEND)
        if rows is not None:
            rows.write.mode("append").parquet(path)
    stored = i.spark.read.schema(schemas.FACT_AD_SPEND).parquet(path)
    return rounded(stored.groupBy("date", "channel_group").agg(F.sum("spend_usd").alias("spend_usd"), F.count(F.lit(1)).alias("rows")))


def _open_windows(i, build) -> str:
    store = work_path(i.spark, "windows")
    staged = jobs.staged_stream(given.raw_event_stream(i.spark, i.folder), given.SITE)
    windows.write_open(build(staged), store, work_path(i.spark, "checkpoint")).awaitTermination()
    return store


@query
def stream_daily_counts(i):
    """Daily counts of a stream over the stored events, of all days: those the watermark has closed and open ones."""
    return windows.daily_counts(i.spark, _open_windows(i, windows.daily_windows)).drop("users_sketch")


@query
def stream_users_by_sketch(i):
    """Users of each channel over all days, exact, and whether the merged sketches of days and channels come within 3 %."""
    daily = windows.daily_counts(i.spark, _open_windows(i, windows.daily_windows))
    exact = i.staged().groupBy("channel_group").agg(F.count_distinct("user_pseudo_id").alias("users"))
    near = F.abs(F.col("approx_users") - F.col("users")) <= 0.03 * F.col("users") + 1
    return exact.join(windows.users_of(daily, ("channel_group",)), "channel_group").select("channel_group", "users", near.alias("near"))


@query
def stream_sessions(i):
    """Inactivity sessions of a stream over the stored events, final and open ones."""
    return windows.sessions(i.spark, _open_windows(i, windows.session_chunks))


@query
def stream_compacted_store(i):
    """The session fact rebuilt from the store of a stream after two compactions, which remove the folders of batches."""
    store = work_path(i.spark, "store")
    raw = given.raw_event_stream(i.spark, i.folder)
    jobs.refresh_session_fact(raw, store, work_path(i.spark, "stream-fact"), work_path(i.spark, "checkpoint"), given.SITE).awaitTermination()
    for _ in range(2):
        jobs.compact_events(i.spark, store, "99999999", running=False)
    return facts.fact_sessions(staging.stg_events(jobs.stored_events(i.spark, store), given.SITE))


@query
def stream_fact_sessions(i):
    """The session fact kept up to date by a stream, exact."""
    fact = work_path(i.spark, "stream-fact")
    raw = given.raw_event_stream(i.spark, i.folder)
    jobs.refresh_session_fact(raw, work_path(i.spark, "store"), fact, work_path(i.spark, "checkpoint"), given.SITE).awaitTermination()
    return i.spark.read.parquet(fact)


def queries() -> dict[str, Query]:
    def bind(build):
        return lambda spark, folder: build(Inputs(spark, folder))

    return {name: bind(build) for name, build in REGISTRY.items()}


