import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martlight.operators import alerts, series, sessions
from martlight.plans import analytics
from martlight.plans.queryspec import last_month


def brute_sessions(events, gap=timedelta(minutes=30)):
    result = {}
    by_user = defaultdict(list)
    for n, user, ts in events:
        by_user[user].append((ts, n))
    for user, items in by_user.items():
        number, previous = 0, None
        for ts, n in sorted(items):
            if previous is None or ts - previous >= gap:
                number += 1
            previous = ts
            result[n] = (user, number)
    return result


def test_inactivity_sessions_by_brute_force(spark):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    steps = [0, 1, 600, 1799, 1800, 1801, 3599, 3600, 86400]
    events, clock = [], defaultdict(lambda: start)
    for n in range(1500):
        # A third of the events belongs to one user.
        user = "hot" if n % 3 == 0 else f"u{rng.randrange(20)}"
        clock[user] += timedelta(seconds=rng.choice(steps), microseconds=rng.choice([0, 1, 999_999]))
        events.append((n, user, clock[user]))
    frame = spark.createDataFrame(events, "n int, user string, ts timestamp")
    want = brute_sessions(events)
    got = {r.n: (r.user, r.session_no) for r in sessions.assign_sessions(frame, "user", "ts").collect()}
    assert got == want
    counts = defaultdict(int)
    for key in want.values():
        counts[key] += 1
    rolled = {(r.user, r.session_no): r.events for r in sessions.inactivity_sessions(frame, "user", "ts").collect()}
    assert rolled == counts


def test_growth_labels_new(spark):
    weeks = [(date(2024, 1, 1) + timedelta(weeks=n), v) for n, v in enumerate([0, 5, 10, 0, 0])]
    frame = spark.createDataFrame(weeks, "week_start date, v bigint")
    got = [(r.change_pct, r.change_label) for r in series.growth(frame, "v").orderBy("week_start").collect()]
    assert got == [(None, None), (None, "New"), (100.0, None), (-100.0, None), (None, None)]


def test_dense_days_fill_per_series(spark):
    rows = [("a", date(2024, 1, 1), 1), ("a", date(2024, 1, 3), 3), (None, date(2024, 1, 2), 2)]
    frame = spark.createDataFrame(rows, "k string, date date, v bigint")
    got = sorted(((r.k or "", r.date.day, r.v) for r in series.dense_days(frame, ("v",), ("k",)).collect()))
    assert got == [("", 2, 2), ("a", 1, 1), ("a", 2, 0), ("a", 3, 3)]


def test_overlay_takes_the_period_before(spark):
    rows = [(date(2024, 1, d), float(d)) for d in (1, 2, 3, 4, 6)]
    frame = spark.createDataFrame(rows, "date date, v double")
    got = [(r.date.day, r.v, r.previous_v) for r in series.period_overlay(frame, ("v",), date(2024, 1, 4), 3).orderBy("date").collect()]
    assert got == [(4, 4.0, 1.0), (5, 0.0, 2.0), (6, 6.0, 3.0)]


def test_last_month_bounds(spark):
    frame = spark.createDataFrame([(date(2024, 3, 31),), (date(2024, 2, 29),), (date(2024, 2, 28),), (date(2024, 3, 30),)], "date date")
    assert sorted(r.date for r in frame.where(last_month(date(2024, 3, 31))).collect()) == [date(2024, 2, 29), date(2024, 3, 30)]


@pytest.mark.parametrize(
    "metric, value, level, header, colour",
    [
        ("cpa", 25.0, "red", True, "red"),
        ("cpa", 15.0, "yellow", False, "yellow"),
        ("cpa", 14.9, "green", False, "yellow"),
        ("approval_rate", -8.0, "yellow", False, "yellow"),
        ("approval_rate", -15.0, "red", True, "yellow"),
        ("funnel_stage", -9.9, "green", False, "yellow"),
        ("funnel_stage", -20.0, "red", True, "red"),
        ("roas", -10.0, "yellow", False, "yellow"),
        ("pacing", 105.0, "green", False, "red"),
        ("pacing", 105.1, "yellow", False, "red"),
        ("pacing", 74.0, "red", False, "red"),
        ("pacing", 116.0, "red", True, "red"),
        ("cpa", None, None, False, None),
    ],
)
def test_alert_levels(spark, metric, value, level, header, colour):
    frame = spark.createDataFrame([(metric, "x", value)], "metric string, subject string, value double")
    row = alerts.classify(frame).first()
    assert (row.level, row.header_alert, row.colour) == (level, header, colour)


def test_approval_curve_and_cohorts(spark):
    day = date(2024, 1, 1)
    rows = [("approved", day, day + timedelta(days=n)) for n in (1, 1, 3, 9)] + [("pending", day, None), ("rejected", day, None)]
    apps = spark.createDataFrame(rows, "status string, apply_date date, approval_date date")
    curve = [r.approved_so_far for r in analytics.approval_curve(apps).orderBy("day").collect()]
    assert curve == [0, 2, 2, 3, 3, 3, 3, 3, 3, 4]
    assert analytics.approval_curve(apps, 2).count() == 3
    row = analytics.cohort_table(apps, date(2024, 1, 10)).first()
    assert (row.applies, row.approved, row.pending, row.avg_days, row.maturing) == (6, 4, 1, 3.5, True)
    assert not analytics.cohort_table(apps, date(2024, 1, 15)).first().maturing


def test_share_of_nothing_is_null(spark):
    frame = spark.createDataFrame([("a", 0), ("b", 0)], "k string, v int")
    assert [r.s for r in frame.select(series.share("v").alias("s")).collect()] == [None, None]
    assert frame.select(F.count(F.lit(1))).first()[0] == 2
