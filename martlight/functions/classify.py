"""Ordered label rules over traffic sources, media, page addresses and bank channels.

A classifier is a list of rules; the first rule that matches gives the label. Rules are data, the
columns are built once from them. The tokens of the operating site (its name, web domain and app
names) come from :class:`Site`, because they belong to the deployment.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlight.functions.columns import one_of, quoted


@dataclass(frozen=True)
class Site:
    """Names of the site whose traffic is analysed."""

    name: str = "mybank"
    domain: str = "mybank.am"
    apps: tuple[str, ...] = ("mymobile", "myonline")
    app_login: str = "mymob"


def like_test(column: str, pattern: str) -> str:
    """LIKE as a SQL condition.

    A pattern with the one-character wildcard needs a regular expression at run time; a plain search for
    its longest literal part goes first, so that the expression runs on few rows only.
    """
    test = f"{column} LIKE {quoted(pattern)}"
    if "_" not in pattern:
        return test
    part = max(pattern.replace("_", "%").split("%"), key=len)
    return f"(contains({column}, {quoted(part)}) AND {test})"


@dataclass(frozen=True)
class Rule:
    """One label. ``equals``/``like``/``like_any_case``/``regex`` test the main column.

    ``medium`` is required in addition to them, ``or_medium``/``or_medium_like`` are alternatives.
    """

    label: str
    equals: tuple[str, ...] = ()
    like: tuple[str, ...] = ()
    like_any_case: tuple[str, ...] = ()
    regex: tuple[str, ...] = ()
    medium: str | None = None
    or_medium: tuple[str, ...] = ()
    or_medium_like: tuple[str, ...] = ()
    or_null: bool = False

    def condition(self, main: str, medium: str | None) -> str:
        tests = []
        if self.equals:
            tests.append(one_of(main, self.equals))
        tests += [like_test(main, pattern) for pattern in self.like]
        tests += [like_test(f"lower({main})", pattern) for pattern in self.like_any_case]
        tests += [f"{main} RLIKE {quoted(pattern)}" for pattern in self.regex]
        if self.or_medium:
            tests.append(one_of(medium, self.or_medium))
        tests += [like_test(medium, pattern) for pattern in self.or_medium_like]
        if self.or_null:
            tests.append(f"{main} IS NULL")
        either = " OR ".join(tests)
        if self.medium is None:
            return either
        same = f"{medium} = {quoted(self.medium)}"
        return f"({either}) AND {same}" if tests else same


def label_column(rules: tuple[Rule, ...], main: str, medium: str | None = None, default: str = "Other") -> Column:
    """One CASE expression over all rules, in order."""
    branches = " ".join(f"WHEN {rule.condition(main, medium)} THEN {quoted(rule.label)}" for rule in rules)
    return F.expr(f"CASE {branches} ELSE {quoted(default)} END")


def source_rules(site: Site) -> tuple[Rule, ...]:
    # Source labels and the source texts that select them, in order of precedence.
    return (
        Rule("Direct", equals=("(direct)",)),
        Rule("Google", equals=("google",)),
        Rule("Bing", equals=("bing",)),
        Rule("Yahoo", like=("%yahoo%",)),
        Rule("Yandex", like=("%yandex%", "ya.%")),
        Rule("NN Ads", like=("NN%", "nn%")),
        Rule(
            "Meta",
            equals=("fb", "ig", "facebook", "instagram", "FB"),
            like=("%Meta%", "%meta%", "%facebook%", "%instagram%", "fb_%", "fb-%", "%fbads%", "%FBads%"),
        ),
        Rule(
            "MS Network",
            equals=("ms_network", "MS", "ms"),
            like=("%MS_%", "%MS-%", "ms_%", "ms-%", "%mediasystem%", "%MediaSystem%"),
        ),
        Rule("Native Ads", like=("%Native%", "%native%")),
        Rule("Intent Ads", like=("%intent%", "%Intent%")),
        Rule("Prodigi Ads", like=("%prodigi%", "%Prodigi%")),
        Rule("Adfox", equals=("adfox",)),
        Rule("LinkedIn", equals=("LinkedIn_ads",), like=("%linkedin%", "%lnkd%")),
        Rule(
            "Email",
            equals=("email", "sfmc", "Mailing", "mailing"),
            like=("%mail.%", "%.mail.%"),
            or_medium=("email",),
        ),
        Rule("SMS", equals=("SMS",), like=("%sms%",)),
        Rule("Viber", like_any_case=("%viber%",)),
        Rule("Telegram", equals=("Telegram",), like=("%telegram%",)),
        Rule("Survey", like=("%survey%",)),
        Rule("Mastercard Promo", like=("%Mastercard%", "%mastercard%")),
        Rule("Internal", equals=("landing", site.name), like=(f"%{site.name}%",)),
        Rule("Armenian Sites", like=("%.am", "%.am:%")),
        Rule("AI Tools", like=("chatgpt%", "claude%", "gemini%", "copilot%", "perplexity%")),
        Rule("Data Not Available", equals=("(not set)",), or_null=True),
    )


def channel_rules() -> tuple[Rule, ...]:
    # Channel groups and the source/medium texts that select them, in order of precedence.
    return (
        Rule("Direct", equals=("(direct)",)),
        Rule("Google Ads", equals=("google",), medium="cpc"),
        Rule("Google Organic", equals=("google",), medium="organic"),
        Rule(
            "Meta Ads",
            equals=("facebook", "fb", "instagram", "ig", "FB"),
            like=("%Meta%", "%instagram%", "%facebook%", "fb_%", "%fbads%"),
        ),
        Rule("NN Ads", like=("NN%", "nn%")),
        Rule(
            "MS Network",
            equals=("ms_network", "MS"),
            like=("%MS_%", "%MS-%", "ms_%", "ms-%", "%mediasystem%", "%MediaSystem%"),
        ),
        Rule("Native Ads", like=("%Native%", "%native%")),
        Rule("Intent Ads", like=("%intent%", "%Intent%")),
        Rule("Prodigi Ads", like=("%prodigi%", "%Prodigi%")),
        Rule("Adfox Video", equals=("adfox",)),
        Rule("LinkedIn", equals=("LinkedIn_ads",), like=("%linkedin%", "%lnkd%")),
        Rule("Email", equals=("email", "sfmc", "Mailing", "mailing"), like=("%mail.%",), or_medium=("email",)),
        Rule("SMS", equals=("SMS",), like=("%sms%",)),
        Rule("Viber", like_any_case=("%viber%",)),
        Rule("Telegram", equals=("Telegram",), like=("%telegram%",)),
        Rule("Yandex", like=("%yandex%", "ya.%")),
        Rule("Bing Organic", equals=("bing",), medium="organic"),
        Rule("Yahoo", like=("%yahoo%",)),
        Rule("Survey", like=("%survey%",)),
        Rule("Referral", medium="referral"),
    )


def product_rules(site: Site) -> tuple[Rule, ...]:
    # Product categories and the page-address texts that select them, in order of precedence.
    return (
        Rule(
            "Support & Info",
            like=(
                "%/contact-us%",
                "%/contact%",
                "%/faq%",
                f"%/about-{site.name}%",
                "%/useful-information%",
                "%/career%",
                "%/press-center%",
                "%/shareholders%",
                "%/corporate-governance%",
                "%/reports%",
            ),
        ),
        Rule("Consumer Loans", like=("%consumer-loans%", "%1-click%", "%sprint%", "%refinance%", "%refinans%")),
        Rule("Car Loans", like=("%car-loan%", "%avtovark%")),
        Rule("Mortgage", like=("%mortgage%",)),
        Rule("Deposits", like=("%deposit%",)),
        Rule("Cards", like=("%card%", "%visa%", "%mastercard%", "%Mastercard%")),
        Rule("Digital Banking", like=tuple(f"%{app}%" for app in site.apps)),
        Rule("Accounts", like=("%account%",)),
        Rule("Business", like=("%/Business%", "%/business%")),
        Rule("Salary Project", like=("%salary%",)),
        Rule("Campaigns", like=("%christmas%", "%black-friday%", "%cyber-monday%", "%pascali%", "%new-year%")),
        Rule(
            "Homepage",
            like=(f"%{site.domain}/hy%", f"%{site.domain}/en%", f"%{site.domain}/ru%"),
            regex=(site.domain.replace(".", r"\.") + r"/?\z",),
        ),
        Rule("User Account", like=("%user-info%", "%personal-info%", "%provision%", "%sign-in%")),
    )


def bank_channel_rules() -> tuple[Rule, ...]:
    # Channel groups of bank rows; sources and media are lower-cased before the test.
    return (
        Rule("Meta Ads", like=("%meta%", "facebook%")),
        Rule("Google Ads", equals=("google",), medium="cpc"),
        Rule("NN Ads", like=("%nn_ads%", "%nn ads%")),
        Rule("Email", equals=("sfmc",), or_medium=("email",)),
        Rule("SMS", equals=("sms",), or_medium_like=("%sms%",)),
        Rule("Viber", like=("%viber%",)),
        Rule("Telegram", like=("%telegram%",)),
        Rule("Referral", medium="referral"),
        Rule("Direct", equals=("landing",)),
        Rule("Yandex", like=("%yandex%",)),
        Rule("Native Ads", like=("%native%",)),
        Rule("Intent Ads", like=("%intent%",)),
        Rule("Prodigi Ads", like=("%prodigi%",)),
        Rule("MS Network", like=("%ms_network%",)),
    )


# Groupings of channel groups and of cleaned sources.
PAID_CHANNELS = (
    "Google Ads", "Meta Ads", "NN Ads", "MS Network", "Native Ads",
    "Intent Ads", "Prodigi Ads", "Adfox Video", "LinkedIn",
)
ORGANIC_CHANNELS = ("Google Organic", "Bing Organic", "Yahoo", "Yandex")
CRM_CHANNELS = ("Email", "SMS", "Viber", "Telegram")
LOCAL_NETWORKS = ("NN Ads", "MS Network", "Native Ads", "Intent Ads", "Prodigi Ads")
OTHER_SEARCH = ("Yandex", "Bing", "Yahoo")

CHANNEL_GROUPS = tuple(rule.label for rule in channel_rules()) + ("Other",)


def source_clean(site: Site, source: str = "source", medium: str = "medium") -> Column:
    return label_column(source_rules(site), source, medium)


def channel_group(source: str = "source", medium: str = "medium") -> Column:
    return label_column(channel_rules(), source, medium)


def product_category(site: Site, page: str = "page_location") -> Column:
    return label_column(product_rules(site), page)


def bank_channel_group(source: str = "acquired_source", medium: str = "acquired_medium") -> Column:
    return label_column(bank_channel_rules(), f"lower({source})", f"lower({medium})")


def channel_type(group: Column) -> Column:
    return (
        F.when(group.isin(*PAID_CHANNELS), "Paid")
        .when(group.isin(*ORGANIC_CHANNELS), "Organic Search")
        .when(group.isin(*CRM_CHANNELS), "CRM")
        .when(group.isin("Direct", "Referral"), group)
        .otherwise("Other")
    )


def is_paid(group: Column) -> Column:
    return F.coalesce(group.isin(*PAID_CHANNELS), F.lit(False))


def channel_category(source: Column) -> Column:
    return (
        F.when(source.isin("Google", "Meta"), source)
        .when(source.isin(*LOCAL_NETWORKS), "Local Ad Networks")
        .when(source.isin(*CRM_CHANNELS), "Direct Messaging")
        .when(source.isin(*OTHER_SEARCH), "Other Search")
        .otherwise("Other")
    )
