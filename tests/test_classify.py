import pytest
from pyspark.sql import functions as F

from martlight.functions import classify
from martlight.functions.classify import Site

SITE = Site(name="acme", domain="acme.am", apps=("acmemobile", "acmeonline"))

# source, medium, source label, channel group
TRAFFIC = [
    ("(direct)", "(none)", "Direct", "Direct"),
    ("google", "cpc", "Google", "Google Ads"),
    ("google", "organic", "Google", "Google Organic"),
    ("google", "referral", "Google", "Referral"),
    ("google", "display", "Google", "Other"),
    ("google", None, "Google", "Other"),
    ("bing", "organic", "Bing", "Bing Organic"),
    ("bing", "cpc", "Bing", "Other"),
    ("mail.yahoo.com", "referral", "Yahoo", "Email"),
    ("search.yahoo.com", "referral", "Yahoo", "Yahoo"),
    ("mail.yandex.ru", "referral", "Yandex", "Email"),
    ("ya.ru", "referral", "Yandex", "Yandex"),
    ("yahya", "web", "Other", "Other"),
    ("NN_banner", "cpc", "NN Ads", "NN Ads"),
    ("nnMeta", "cpc", "NN Ads", "Meta Ads"),
    ("FB", "paid", "Meta", "Meta Ads"),
    ("metabase", "referral", "Meta", "Referral"),
    # The underscore of a pattern stands for any character, also for the hyphen.
    ("fb-promo", "cpc", "Meta", "Meta Ads"),
    ("fb_promo", "cpc", "Meta", "Meta Ads"),
    ("fb", "paid", "Meta", "Meta Ads"),
    ("xFBadsx", "cpc", "Meta", "Other"),
    ("xfbadsx", "cpc", "Meta", "Meta Ads"),
    ("ms", "cpc", "MS Network", "Other"),
    ("MS", "cpc", "MS Network", "MS Network"),
    ("msn", "organic", "MS Network", "MS Network"),
    ("SMS_promo", "sms", "MS Network", "MS Network"),
    ("SMS", "sms", "SMS", "SMS"),
    ("xMS", "web", "Other", "Other"),
    ("my sms", "web", "SMS", "SMS"),
    ("MediaSystem", "cpc", "MS Network", "MS Network"),
    ("NativeAds", "cpc", "Native Ads", "Native Ads"),
    ("Intent", "cpc", "Intent Ads", "Intent Ads"),
    ("prodigi", "cpc", "Prodigi Ads", "Prodigi Ads"),
    ("adfox", "video", "Adfox", "Adfox Video"),
    ("adfox2", "video", "Other", "Other"),
    ("lnkd.in", "referral", "LinkedIn", "LinkedIn"),
    ("sfmc", "crm", "Email", "Email"),
    ("partner", "email", "Email", "Email"),
    (None, "email", "Email", "Email"),
    (None, "referral", "Data Not Available", "Referral"),
    (None, None, "Data Not Available", "Other"),
    ("(not set)", "(not set)", "Data Not Available", "Other"),
    ("VIBER_bot", "msg", "Viber", "Viber"),
    ("telegram.org", "referral", "Telegram", "Telegram"),
    ("TELEGRAM", "web", "Other", "Other"),
    ("survey1", "web", "Survey", "Survey"),
    ("Mastercard", "promo", "Mastercard Promo", "Other"),
    ("landing", "web", "Internal", "Other"),
    ("www.acme.am", "referral", "Internal", "Referral"),
    ("news.am", "referral", "Armenian Sites", "Referral"),
    ("news.am:8080", "web", "Armenian Sites", "Other"),
    ("chatgpt.com", "referral", "AI Tools", "Referral"),
    ("blog.example", "referral", "Other", "Referral"),
    ("", "", "Other", "Other"),
]

PAGES = [
    ("https://www.acme.am/en/contact-us?card=1", "Support & Info"),
    ("https://www.acme.am/about-acme", "Support & Info"),
    ("https://www.acme.am/hy/Individual/consumer-loans", "Consumer Loans"),
    ("https://sprint.example/x", "Consumer Loans"),
    ("https://www.acme.am/en/car-loan", "Car Loans"),
    ("https://www.acme.am/ru/mortgage", "Mortgage"),
    ("https://www.acme.am/deposit/card", "Deposits"),
    ("https://x.example/discard", "Cards"),
    ("https://www.acme.am/acmemobile", "Digital Banking"),
    ("https://www.acme.am/current-account", "Accounts"),
    ("https://www.acme.am/en/Business/x", "Business"),
    ("https://x.example/salary", "Salary Project"),
    ("https://x.example/new-year", "Campaigns"),
    ("https://www.acme.am/en/whatever", "Homepage"),
    ("https://www.acme.am", "Homepage"),
    ("https://www.acme.am/", "Homepage"),
    ("https://www.acmexam/", "Other"),
    ("https://www.acme.am/xx", "Other"),
    ("https://reg.example/sign-in", "User Account"),
    ("https://x.example/else", "Other"),
    (None, "Other"),
]

BANK = [
    ("Meta_ads", "cpc", "Meta Ads"),
    ("facebook.com", None, "Meta Ads"),
    ("my facebook", None, "Other"),
    ("Google", "CPC", "Google Ads"),
    ("google", "organic", "Other"),
    ("NN ads", None, "NN Ads"),
    ("SFMC", None, "Email"),
    ("x", "Email", "Email"),
    (None, "email", "Email"),
    ("sms", "x", "SMS"),
    (None, "my_SMS", "SMS"),
    ("viber", None, "Viber"),
    ("telegram", "referral", "Telegram"),
    ("yandex", "referral", "Referral"),
    ("landing", None, "Direct"),
    ("yandex", None, "Yandex"),
    ("native", None, "Native Ads"),
    ("intent", None, "Intent Ads"),
    ("prodigi", None, "Prodigi Ads"),
    ("ms_network", None, "MS Network"),
    ("msXnetwork", None, "MS Network"),
    (None, None, "Other"),
]


def test_sources_and_channels(spark):
    frame = spark.createDataFrame([row[:2] for row in TRAFFIC], "source string, medium string")
    got = frame.select("source", "medium", classify.source_clean(SITE), classify.channel_group()).collect()
    assert [tuple(r) for r in got] == TRAFFIC


def test_pages(spark):
    frame = spark.createDataFrame([row[:1] for row in PAGES], "page_location string")
    got = frame.select("page_location", classify.product_category(SITE)).collect()
    assert [tuple(r) for r in got] == PAGES


def test_bank_channels(spark):
    frame = spark.createDataFrame([row[:2] for row in BANK], "acquired_source string, acquired_medium string")
    got = frame.select("*", classify.bank_channel_group()).collect()
    assert [tuple(r) for r in got] == BANK


@pytest.mark.parametrize(
    "group, kind, paid",
    [
        ("Google Ads", "Paid", True),
        ("LinkedIn", "Paid", True),
        ("Yandex", "Organic Search", False),
        ("Viber", "CRM", False),
        ("Direct", "Direct", False),
        ("Referral", "Referral", False),
        ("Survey", "Other", False),
        (None, "Other", False),
    ],
)
def test_channel_groupings(spark, group, kind, paid):
    frame = spark.createDataFrame([(group,)], "g string")
    row = frame.select(classify.channel_type(F.col("g")), classify.is_paid(F.col("g"))).first()
    assert tuple(row) == (kind, paid)
