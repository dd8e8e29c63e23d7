"""What must hold when inputs are damaged, have gaps or repeat."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martlight.functions.columns import flexible_date
from martlight.operators.sessions import inactivity_sessions
from martlight.operators.sinks import path_exists, replace_table
from martlight.plans import analytics, charts, queryspec, staging
from martlight.plans.refresh import read_mart, refresh
from workload import adapters as given


def test_damaged_statistics_fail_only_their_tables(spark, small, tmp_path):
    bad = tmp_path / "stats"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"PAR1 not parquet PAR1")
    schema = given.google_ads_stats(spark, small).schema
    stats = spark.read.schema(schema).parquet(str(bad))
    outcome = refresh(spark, given.raw_events(spark, small), str(tmp_path / "w"), given.AS_OF, google_stats=stats, site=given.SITE)
    rows = {r.table: (r.ok, r.error) for r in outcome.status.collect()}
    assert [t for t, (ok, _) in rows.items() if not ok] == ["fact_ad_spend_google"] and len(rows) == 9 and not outcome.ok
    assert read_mart(spark, f"{tmp_path}/w", "funnel_loans").count() > 0


def test_a_failed_write_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    with pytest.raises(Exception, match="boom"):
        replace_table(spark.range(3).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("boom"))).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 5 and not path_exists(spark, str(tmp_path / "none"))


def test_long_series_keep_the_newest_day(spark):
    days = spark.range(1200).selectExpr("date_add(DATE'2020-01-01', CAST(id AS INT)) AS date", "'c' AS channel_group", "1 AS sessions", "1 AS users")
    for name in ("daily_performance_trend", "channel_trend"):
        rows = queryspec.run(charts.CHARTS[name], days).collect()
        assert len(rows) == 1200 and max(r.date for r in rows) == date(2020, 1, 1) + timedelta(days=1199)


def test_week_change_over_a_gap(spark):
    rows = [(date(2024, 1, 1), 10), (date(2024, 1, 22), 20)]
    got = analytics.funnel_change(spark.createDataFrame(rows, "date date, users long"), ("users",)).orderBy("week_start").collect()
    assert [(r.users, r.previous, r.change_pct) for r in got] == [(10, None, None), (0, 10, -100.0), (0, 0, None), (20, 0, None)]


def test_personal_data(spark):
    row = ("u", "t", "https://s/a?phone=1", "http://r/?phone=374#x")
    frame = spark.createDataFrame([row], "user_id string, access_token_sub_id string, page_location string, page_referrer string")
    one, other = (staging.without_personal_data(frame, salt=s).first() for s in ("a", "b"))
    assert one.page_referrer == "http://r/" and "phone" not in str(one) and one.user_hash != other.user_hash
    assert "user_hash" not in staging.without_personal_data(frame).columns


@pytest.mark.parametrize("text", ["2026-01-15", "1/15/2026 10:30:00", "1/15/2026 10:30", "2026/01/15", "15.01.2026", "Jan 15, 2026"])
def test_date_forms(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(flexible_date(F.col("t"))).first()[0] == date(2026, 1, 15)


def test_events_of_nobody_are_no_session(spark):
    frame = spark.createDataFrame([(None, datetime(2024, 1, 1)), ("u", datetime(2024, 1, 1))], "user string, ts timestamp")
    assert [r.user for r in inactivity_sessions(frame, "user", "ts").collect()] == ["u"]


def test_a_mapping_with_repeats_is_refused(spark, small):
    rows = spark.createDataFrame([("a", "b", "f", 1)] * 2, "original_event string, clean_event string, flow string, funnel_step int")
    with pytest.raises(ValueError, match="more than once"):
        staging.stg_events_clean(staging.stg_events(given.raw_events(spark, small), given.SITE), mapping=rows, site=given.SITE)
