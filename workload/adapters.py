"""Inputs of the engine derived from the given tables by row-wise projections, whole tables each time."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.functions.classify import Site
from martlight.sources.literals import channel_codes
from martlight.sources.readers import literal_table
from martlight.sources.schemas import MONTHLY_BUDGETS, MONTHLY_TARGETS
from martlight.streaming.jobs import event_stream

AS_OF = date(2024, 1, 31)
LOADED_AT = datetime(2024, 1, 31, 6, 0, 0)
SITE = Site()

# (source, medium) by index, reaching every source and channel rule.
TRAFFIC = (
    ("(direct)", "(none)"), ("google", "cpc"), ("google", "organic"), ("google", "referral"), ("bing", "organic"),
    ("bing", "cpc"), ("search.yahoo.com", "referral"), ("mail.yahoo.com", "referral"), ("yandex.ru", "organic"),
    ("ya.ru", "referral"), ("NN_banner", "cpc"), ("nnads", "cpc"), ("fb", "paid"), ("ig", "social"),
    ("Meta_ads", "cpc"), ("metabase", "referral"), ("fb-promo", "cpc"), ("MS_network", "cpc"), ("ms", "cpc"),
    ("msn", "organic"), ("SMS_promo", "sms"), ("SMS", "sms"), ("NativeAds", "cpc"), ("intent", "cpc"),
    ("Prodigi", "cpc"), ("adfox", "video"), ("LinkedIn_ads", "cpc"), ("lnkd.in", "referral"), ("sfmc", "crm"),
    ("partner", "email"), ("Viber_bot", "msg"), ("telegram.org", "referral"), ("survey1", "web"),
    ("Mastercard", "promo"), ("landing", "web"), ("news.am", "referral"), ("chatgpt.com", "referral"),
    ("(not set)", "(not set)"), (None, "email"), (None, "referral"), ("blog.example", "referral"),
    ("news.am:8080", "web"),
)

# Page addresses by index, reaching every product rule.
PAGES = (
    "https://www.mybank.am/", "https://www.mybank.am/hy/Individual/consumer-loans", "https://www.mybank.am/en/1-click",
    "https://sprint.example/start", "https://www.mybank.am/en/refinance", "https://www.mybank.am/en/car-loan",
    "https://www.mybank.am/ru/mortgage", "https://www.mybank.am/en/deposit/simple", "https://www.mybank.am/en/visa-gold",
    "https://x.example/discard", "https://www.mybank.am/mymobile", "https://www.mybank.am/current-account",
    "https://www.mybank.am/en/Business/x", "https://x.example/salary", "https://x.example/black-friday",
    "https://www.mybank.am/hy/other", "https://reg.example/sign-in", "https://www.mybank.am/en/contact-us?card=1",
    "https://www.mybank.am/en/faq", None, "https://x.example/else",
)

# Event names by event type and index.
EVENT_NAMES = {
    "click": (
        "sprint_apply_button_click", "reg_apply_button_click", "cards_apply_button", "apply_button_click",
        "check_limit_click", "sign_in_click", "Reg_apply_button_click",
    ),
    "signup": (
        "Get Sub ID sprint", "Get Sub ID", "phone_submited_sprint", "phone_submited_reg", "spint_ssn_sumpited",
        "kyc_start", "registration_success",
    ),
    "purchase": (
        "registration_success", "sprint_check_limit_comleted", "otp_submited_sprint", "ssn_submitted",
        "otp_email_verified", "sprint_open_personal_account", "login via mymob sprint",
    ),
    "error": (
        "test_visa_p", "exchange_page_view", "file_download", "sprint_login_mobile_start", "kyc_qr_shown",
        "kyc_qr_scanned", "user_engagement",
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _literal(value) -> str:
    return "CAST(NULL AS STRING)" if value is None else f"'{value}'"


def _picked(values, index: str) -> str:
    return f"element_at(array({', '.join(_literal(v) for v in values)}), CAST({index} AS INT) + 1)"


def _pick(values, index: Column) -> Column:
    return F.element_at(F.expr(f"array({', '.join(_literal(v) for v in values)})"), (index + 1).cast("int"))


def _param(key: str, text: str = "CAST(NULL AS STRING)", number: str = "CAST(NULL AS BIGINT)") -> str:
    value = f"named_struct('string_value', {text}, 'int_value', CAST({number} AS BIGINT))"
    return f"named_struct('key', '{key}', 'value', {value})"


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """The nested raw event shape from the events table."""
    return raw_shape(table(spark, folder, "events"))


def raw_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows as a stream that reads the files of the events table."""
    schema = table(spark, folder, "events").schema
    # A pattern that matches the name only: the source takes a plain path for a folder, and a table may be one file.
    return raw_shape(event_stream(spark, f"{folder}/events.parque[t]", schema))


def raw_shape(events: DataFrame) -> DataFrame:
    base = events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "CAST(ts AS TIMESTAMP) AS ts",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k",
        "CAST(dayofmonth(ts) * 4 + floor(hour(ts) / 6.0D) AS BIGINT) AS sid",
    )
    return shape_events(base)


def shape_events(base: DataFrame) -> DataFrame:
    names = " ".join(
        f"WHEN event_type = '{kind}' THEN {_picked(names, 'k % 7')}" for kind, names in EVENT_NAMES.items()
    )
    params = (
        _param("ga_session_id", number="CASE WHEN event_id % 97 <> 0 THEN sid END"),
        _param("ga_session_number", number="(user_id * 7 + sid * 3) % 5 + 1"),
        _param("page_location", text=_picked(PAGES, "(k + event_id) % 21")),
        _param("page_title", text="concat('Page ', (k + event_id) % 21)"),
        _param("page_referrer", text="CASE WHEN k % 2 = 0 THEN 'https://ref.example/' END"),
        _param("Access Token Sub ID", text="CASE WHEN event_type = 'signup' THEN concat('tok', k) END"),
        _param("engagement_time_msec", number="CASE WHEN k % 10 <> 0 THEN floor(value * 100) END"),
        _param("session_engaged", number="CASE WHEN value >= 10 THEN 1 ELSE 0 END"),
    )
    traffic = "(user_id + sid) % 42"
    return base.selectExpr(
        "date_format(ts, 'yyyyMMdd') AS event_date",
        "unix_micros(ts) AS event_timestamp",
        f"CASE {names} ELSE 'page_view' END AS event_name",
        "CASE WHEN event_id % 211 <> 0 THEN concat('u', user_id) END AS user_pseudo_id",
        "CASE WHEN user_id % 4 = 0 THEN concat('login', user_id) END AS user_id",
        "'WEB' AS platform",
        f"array({', '.join(params)}) AS event_params",
        f"""named_struct('source', {_picked([s for s, _ in TRAFFIC], traffic)},
            'medium', {_picked([m for _, m in TRAFFIC], traffic)},
            'name', CASE WHEN user_id % 6 <> 0 THEN concat('camp_', user_id % 6) END) AS traffic_source""",
        f"""named_struct('category', {_picked(("mobile", "desktop", "tablet"), "user_id % 3")},
            'mobile_brand_name', {_picked(("Apple", "Samsung", None), "user_id % 3")},
            'operating_system', {_picked(("iOS", "Windows", "Android"), "user_id % 3")},
            'web_info', named_struct('browser', {_picked(("Safari", "Chrome"), "user_id % 2")})) AS device""",
        f"""named_struct('country', CASE WHEN user_id % 5 = 4 THEN 'Georgia' ELSE 'Armenia' END,
            'city', {_picked(("Yerevan", "Gyumri", "Vanadzor", None, "Tbilisi"), "user_id % 5")}) AS geo""",
    )


def _january(index: Column) -> Column:
    return F.date_add(F.lit(date(2024, 1, 1)), (index % 30).cast("int"))


def google_ads_stats(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(
            _january(F.col("l_orderkey")).alias("data_date"),
            F.concat(F.lit("camp_"), (F.col("l_partkey") % 6).cast("string")).alias("campaign_name"),
            F.concat(F.lit("ag_"), F.col("l_linenumber").cast("string")).alias("ad_group_name"),
            (F.floor("l_quantity") * (F.col("l_partkey") % 20)).alias("impressions"),
            (F.col("l_partkey") % 50).alias("clicks"),
            F.floor(F.col("l_extendedprice") * 10000).alias("cost_micros"),
            (F.col("l_suppkey") % 4).cast("double").alias("conversions"),
        )
    )


def meta_insights(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .where(F.col("l_returnflag") != "R")
        .select(
            _january(F.col("l_orderkey")).alias("date_start"),
            F.concat(F.lit("camp_"), (F.col("l_partkey") % 6).cast("string")).alias("campaign_name"),
            F.concat(F.lit("set_"), F.col("l_linenumber").cast("string")).alias("adset_name"),
            (F.floor("l_quantity") * (F.col("l_partkey") % 20)).alias("impressions"),
            (F.col("l_partkey") % 50).alias("clicks"),
            (F.col("l_extendedprice") / 100).alias("spend"),
            F.col("l_partkey").alias("reach"),
        )
    )


def landed_spend(spark: SparkSession, folder: str) -> DataFrame:
    """The generic spend landing table, with costs in two currencies."""
    return table(spark, folder, "lineitem").select(
        _january(F.col("l_orderkey")).alias("date"),
        _pick(("google_ads", "meta_ads", "linkedin"), F.col("l_suppkey") % 3).alias("channel"),
        F.concat(F.lit("camp_"), (F.col("l_partkey") % 6).cast("string")).alias("campaign_name"),
        F.floor("l_quantity").alias("impressions"),
        (F.col("l_partkey") % 50).alias("clicks"),
        F.col("l_extendedprice").alias("cost"),
        _pick(("USD", "amd"), F.col("l_linenumber") % 2).alias("currency"),
    )


def spend_drops(spark: SparkSession, folder: str, path: str) -> str:
    """Landed spend as two drops: one as it is, one with the dates as numbers and the figures as text."""
    rows = landed_spend(spark, folder)
    odd = F.col("campaign_name").isin("camp_1", "camp_4")
    rows.where(~odd).write.parquet(f"{path}/drop=1")
    text = {c: F.concat(F.lit(" "), F.col(c).cast("string")) for c in ("impressions", "clicks", "cost")}
    other = rows.where(odd).withColumns(text).withColumn("date", F.date_format("date", "yyyyMMdd").cast("int"))
    other.write.parquet(f"{path}/drop=2")
    return path


def insight_drops(spark: SparkSession, folder: str, path: str) -> str:
    """Insights as two drops: one as they are, one all text, with missing and unreadable figures."""
    rows = meta_insights(spark, folder)
    odd = F.col("reach") % 3 == 0
    rows.where(~odd).write.parquet(f"{path}/drop=1")
    text = rows.where(odd).select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    text = text.withColumn("clicks", F.when(F.col("reach").endswith("5"), "many").when(F.col("reach").endswith("4"), "N/A").otherwise(F.col("clicks")))
    text.withColumn("impressions", F.concat("impressions", F.lit(".0"))).write.parquet(f"{path}/drop=2")
    return path


BANK_SOURCES = ("Meta_ads", "google", "NN ads", "sfmc", "SMS", "landing", "yandex", "ms_network", None)
BANK_MEDIA = ("cpc", "email", "referral", None)


def bank_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Raw bank rows from the orders table, in the schema of the raw bank table."""
    key, customer, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")

    def flag(condition):
        return F.when(condition, 1).otherwise(0).cast("bigint")

    return table(spark, folder, "orders").select(
        F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("event_time_raw"),
        _january(customer).alias("event_date"),
        F.lit("approved").alias("event_name"),
        F.concat(F.lit("t"), key.cast("string")).alias("token_id"),
        _pick(BANK_SOURCES, key % 9).alias("acquired_source"),
        _pick(BANK_MEDIA, key % 4).alias("acquired_medium"),
        F.concat(F.lit("camp_"), (customer % 6).cast("string")).alias("acquired_campaign"),
        F.concat(F.lit("c"), customer.cast("string")).alias("client_code"),
        F.lit(None).cast("string").alias("soc_card"),
        F.lit(0).cast("bigint").alias("count_soc_card"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("had_product"),
        (key % 2).alias("is_first_interaction"),
        flag(key % 5 == 0).alias("loan_count"),
        F.when(key % 5 == 0, price).otherwise(0.0).alias("loan_amount"),
        flag(key % 5 == 1).alias("deposit_count"),
        F.when(key % 5 == 1, price).otherwise(0.0).alias("deposit_amount"),
        flag((key % 5).isin(0, 2)).alias("card_count"),
        F.lit(datetime(2024, 1, 30, 6, 0, 0)).alias("uploaded_at"),
    )


def merge_target(rows: DataFrame) -> DataFrame:
    return rows.where(F.substring("token_id", -1, 1) < "7")


def merge_source(rows: DataFrame) -> DataFrame:
    """Half of the rows with higher amounts and a later upload; every hundredth twice, some without a token."""
    late = rows.where(F.substring("token_id", -1, 1) >= "5").withColumns(
        {
            "loan_amount": F.col("loan_amount") + 1,
            "deposit_amount": F.col("deposit_amount") + 1,
            "uploaded_at": F.lit(LOADED_AT),
            "token_id": F.when(~F.col("token_id").endswith("77"), F.col("token_id")),
        }
    )
    newer = late.where(F.col("token_id").endswith("55")).withColumns(
        {"uploaded_at": F.lit(datetime(2024, 1, 31, 7, 0, 0)), "card_count": F.col("card_count") + 10}
    )
    return late.unionByName(newer)


def bank_export(rows: DataFrame) -> DataFrame:
    """Bank rows under the headers of the export, all text, with the blemishes of such files."""
    last = F.substring("token_id", -1, 1)
    return rows.select(
        F.col("event_time_raw").alias("Event Time"),
        F.date_format("event_date", "yyyy-MM-dd").alias("Event _date"),
        F.when(last == "3", "Кредит").otherwise(F.col("event_name")).alias("Event Name"),
        F.when(last == "9", "nan").otherwise(F.col("token_id")).alias("Event Param Value (String)"),
        F.col("acquired_source").alias("Acquired Source"),
        F.col("acquired_medium").alias("Acquired Medium"),
        F.col("acquired_campaign").alias("Acquired Campaign"),
        F.col("client_code").alias("Client_code"),
        F.col("had_product").alias("HAD_PRODUCT"),
        F.col("is_first_interaction").cast("string").alias("1-st/2-nd"),
        F.when(last == "4", F.concat(F.col("loan_count").cast("string"), F.lit(".7")))
        .otherwise(F.col("loan_count").cast("string"))
        .alias("LOAN_COUNT"),
        F.when(last == "6", "n/k").otherwise(F.format_string("%.2f", "loan_amount")).alias("LOAN_AMOUNT"),
        F.col("deposit_count").cast("string").alias("DEPOSIT_COUNT"),
        F.format_string("%.2f", "deposit_amount").alias("DEPOSIT_AMOUNT"),
        F.col("card_count").cast("string").alias("CARD_COUNT"),
    )


def damaged_export(rows: DataFrame, named: bool = False) -> DataFrame:
    """An export with unreadable and missing dates, missing clients or negative figures, by the number of the client (with ``named`` of the token)."""
    export = bank_export(rows)
    number = F.substring("Event Param Value (String)" if named else "Client_code", 2, 20).try_cast("long")
    day = F.when(number % 40 == 1, "31/31/2024").when(number % 40 == 2, "NaN").otherwise(F.col("Event _date"))
    export = export.withColumn("Event _date", day)
    if named:
        return export.withColumn("DEPOSIT_AMOUNT", F.when(number % 40 == 11, "-5.00").otherwise(F.col("DEPOSIT_AMOUNT")))
    return export.withColumn("Client_code", F.when(number % 40 == 3, "").otherwise(F.col("Client_code")))


def mixed_exports(rows: DataFrame, path: str) -> str:
    """Bank rows as an export of files in UTF-8 and in the Cyrillic code page, with several forms of dates and quoted line breaks."""
    last, day = F.substring("Event Param Value (String)", -1, 1), F.col("Event _date").cast("date")
    other_form = F.when(last == "1", F.date_format(day, "M/d/yyyy H:mm:ss")).when(last == "2", F.date_format(day, "dd.MM.yyyy"))
    rows = rows.withColumn("event_name", F.when(F.col("token_id").endswith("8"), "two\nlines").otherwise(F.col("event_name")))
    export = bank_export(rows).withColumn("_odd", F.crc32(F.col("Client_code").cast("binary")) % 2)
    export = export.withColumn("Event _date", F.coalesce(other_form, F.col("Event _date")))
    upper = bytes(range(0x80, 0x100))
    cyrillic, latin = upper.decode("cp1251", errors="replace"), upper.decode("latin1")
    utf8, other = export.where("_odd = 0").drop("_odd"), export.where("_odd = 1").drop("_odd")
    utf8.write.option("header", True).option("escape", '"').csv(f"{path}/utf8")
    # Spark writes Latin-1, not the Cyrillic code page; the bytes are the same.
    other = other.withColumn("Event Name", F.translate("Event Name", cyrillic, latin))
    other.write.option("header", True).option("escape", '"').option("encoding", "ISO-8859-1").csv(f"{path}/cyrillic")
    return f"{path}/*"


def bank_applications(spark: SparkSession, folder: str) -> DataFrame:
    """Application rows with untidy texts."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        F.concat(F.lit("APP-"), key.cast("string")).alias("application_id"),
        _january(F.col("o_custkey")).alias("application_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(_january(F.col("o_custkey")), 2)).alias("approved_date"),
        F.lit(None).cast("timestamp").alias("uploaded_at"),
        _pick((" Loan", "CARD ", "deposit"), key % 3).alias("product_type"),
        F.col("o_orderpriority").alias("product_name"),
        F.when(F.col("o_orderstatus") == "F", " Approved ").otherwise("PENDING").alias("status"),
        F.concat(F.lit("+374 (0"), (key % 90 + 10).cast("string"), F.lit(") 12-34-"), F.col("o_custkey").cast("string")).alias("user_phone"),
        F.concat(F.lit(" Client"), F.col("o_custkey").cast("string"), F.lit("@Mail.example ")).alias("user_email"),
        F.col("o_totalprice").alias("amount"),
        _pick(("amd", "usd", None), key % 3).alias("currency"),
    )


def applications(spark: SparkSession, folder: str) -> DataFrame:
    """Approval rows with the channel code of their source."""
    key = F.col("o_orderkey")
    approved = F.col("o_orderstatus") == "F"
    return table(spark, folder, "orders").select(
        F.concat(F.lit("APP-"), key.cast("string")).alias("application_id"),
        _pick(("loan", "card", "deposit"), key % 3).alias("product_type"),
        _january(F.col("o_custkey")).alias("apply_date"),
        _pick(("google", "meta", "direct"), key % 3).alias("apply_source"),
        _pick(("google_ads", "meta_ads", "direct"), (key + F.col("o_custkey")) % 3).alias("apply_channel"),
        F.when(approved, "approved").when(F.col("o_orderstatus") == "O", "rejected").otherwise("pending").alias("status"),
        F.when(approved, F.date_add(_january(F.col("o_custkey")), (key % 7 + 1).cast("int"))).alias("approval_date"),
        F.when(approved, F.col("o_totalprice")).otherwise(0.0).alias("revenue_amd"),
    )


TARGETS = (
    ("revenue", "all", "all", 400_000_000.0), ("revenue", "all", "loan", 200_000_000.0),
    ("revenue", "all", "card", 150_000_000.0), ("revenue", "all", "deposit", 100_000_000.0),
    ("approved", "all", "all", 5000.0), ("approved", "all", "loan", 2000.0), ("cpa", "all", "all", 3000.0),
    ("cpa", "google_ads", "all", 2500.0), ("cpa", "meta_ads", "all", 2000.0), ("roas", "all", "all", 0.05),
    ("roas", "google_ads", "all", 0.04), ("roas", "meta_ads", "all", 0.03), ("approval_rate", "all", "all", 35.0),
    ("approval_rate", "all", "loan", 60.0), ("approval_rate", "all", "card", 30.0),
    ("revenue", "google_ads", "loan", 60_000_000.0),
)
BUDGETS = (("google_ads", 9_000_000.0, 290_000.0), ("meta_ads", 7_000_000.0, None), ("linkedin", 3000.0, 97.0))
MONTH = date(2024, 1, 1)


def targets(spark: SparkSession) -> DataFrame:
    return literal_table(spark, MONTHLY_TARGETS, [(MONTH, *row, None) for row in TARGETS])


def budgets(spark: SparkSession) -> DataFrame:
    return literal_table(spark, MONTHLY_BUDGETS, [(MONTH, *row, None) for row in BUDGETS])


def codes(spark: SparkSession) -> DataFrame:
    return channel_codes(spark)
