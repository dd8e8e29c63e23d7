"""Versioned tables, and refreshes that publish only what passes its checks."""

import threading
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from martlight.operators import versions
from martlight.plans import refresh as refreshes
from martlight.plans.refresh import read_mart, refresh
from workload import adapters as given


def days(spark, *values):
    return spark.createDataFrame([(None if d is None else date(2024, 1, d), n) for d, n in values], "date date, n bigint")


def content(frame):
    return sorted((r.date.day if r.date else 0, r.n) for r in frame.collect())


def test_a_reader_sees_one_whole_version(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(days(spark, (1, 1), (2, 2), (None, 9)), path, "date")
    before = versions.read(spark, path)
    draft = versions.write(days(spark, (1, 10), (3, 30)), path, "date")
    # written, not published
    assert content(versions.read(spark, path)) == [(0, 9), (1, 1), (2, 2)]
    versions.publish(spark, draft)
    assert content(versions.read(spark, path)) == [(1, 10), (3, 30)]
    # a frame that was opened before goes on with its version, and the number names it
    assert content(before) == content(versions.read(spark, path, 1)) == [(0, 9), (1, 1), (2, 2)]


def test_recent_days_are_replaced_and_older_ones_not_copied(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(days(spark, (1, 1), (2, 2), (3, 3)), path, "date")
    new = versions.replace(days(spark, (1, 100), (3, 30), (5, 50)), path, "date", since=date(2024, 1, 2))
    assert content(versions.read(spark, path)) == [(1, 1), (3, 30), (5, 50)]
    assert len({e.version for e in new.entries}) == 2
    versions.replace(days(spark, (9, 9)).limit(0), path, "date", since=date(2024, 1, 4))
    assert content(versions.read(spark, path)) == [(1, 1), (3, 30)]
    versions.replace(days(spark, (9, 9)).limit(0), path, "date")
    assert versions.read(spark, path).count() == 0 and versions.read(spark, path).columns == ["date", "n"]


def test_failed_writes_and_publications_change_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.replace(spark.range(5), path)
    broken = spark.range(3).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("boom"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        versions.replace(broken, path)
    assert versions.read(spark, path).count() == 5
    one, other = versions.write(spark.range(1), path), versions.write(spark.range(2), path)
    # both writers take the number for free; one gets it
    numbers = versions._numbers(spark, path)
    monkeypatch.setattr(versions, "_numbers", lambda *_: numbers)
    versions.publish(spark, one)
    with pytest.raises(versions.Conflict):
        versions.publish(spark, other)
    monkeypatch.undo()
    assert versions.published(spark, path).number == 2 and versions.read(spark, path).count() == 1


def test_expired_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        versions.replace(days(spark, (1, n), (2 + n, n)), path, "date", since=date(2024, 1, 1 + n))
    versions.write(days(spark, (1, 77)), path, "date")
    gone = versions.expire(spark, path, keep=1)
    assert len(gone) == 3 and content(versions.read(spark, path)) == [(1, 0), (5, 3)]
    assert versions.expire(spark, str(tmp_path / "none")) == []
    with pytest.raises(ValueError, match="nothing is published"):
        versions.read(spark, str(tmp_path / "none"))


@pytest.fixture(scope="module")
def good(spark, small, tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("published"))
    outcome = refresh(spark, given.raw_events(spark, small), warehouse, given.AS_OF, google_stats=given.google_ads_stats(spark, small), meta_insights=given.meta_insights(spark, small), site=given.SITE)
    return warehouse, outcome


def test_a_mart_with_a_failed_check_keeps_its_old_version(spark, small, good):
    warehouse, first = good
    assert {r.published for r in first.published.collect()} == {True} and first.ok
    old = read_mart(spark, warehouse, "fact_ad_spend").agg(F.sum("spend_usd"), F.count("*")).first()
    bad = given.google_ads_stats(spark, small).withColumn("cost_micros", -F.col("cost_micros") - 1)
    again = refresh(spark, given.raw_events(spark, small), warehouse, given.AS_OF, google_stats=bad, meta_insights=given.meta_insights(spark, small), site=given.SITE)
    found = {r.table: r for r in again.published.collect()}
    assert [t for t, r in found.items() if not r.published] == ["fact_ad_spend"] and not again.ok
    assert found["fact_ad_spend"].reason == "AD-02 negative cost" and found["fact_sessions"].number == 2
    assert read_mart(spark, warehouse, "fact_ad_spend").agg(F.sum("spend_usd"), F.count("*")).first() == old
    held = refresh(
        spark, given.raw_events(spark, small), warehouse, given.AS_OF, google_stats=bad,
        meta_insights=given.meta_insights(spark, small), site=given.SITE, together=True,
    )
    assert not any(r.published for r in held.published.collect())
    assert versions.published(spark, refreshes.marts_path(warehouse, "fact_sessions")).number == 2


def test_no_data_of_yesterday_publishes_no_fact(spark, small, good):
    warehouse, _ = good
    before = read_mart(spark, warehouse, "fact_conversions").count()
    late = refresh(spark, given.raw_events(spark, small), warehouse, given.AS_OF + timedelta(days=9), site=given.SITE)
    found = {r.table: r.published for r in late.published.collect()}
    assert not found["fact_sessions"] and not found["fact_conversions"] and found["dim_channel"]
    assert read_mart(spark, warehouse, "fact_conversions").count() == before


def test_meta_alone_is_built(spark, small, tmp_path):
    outcome = refresh(spark, given.raw_events(spark, small), str(tmp_path), given.AS_OF, meta_insights=given.meta_insights(spark, small), site=given.SITE)
    assert outcome.ok and {r.channel_group for r in read_mart(spark, str(tmp_path), "fact_ad_spend").collect()} == {"Meta Ads"}


def test_scanned_files_fall_with_the_days(spark, small, tmp_path):
    raw = given.raw_events(spark, small)
    raw.repartition("event_date").write.partitionBy("event_date").parquet(str(tmp_path / "landed"))
    landed = spark.read.schema(raw.schema).parquet(str(tmp_path / "landed"))
    first = refresh(spark, landed, str(tmp_path / "w"), given.AS_OF, full=True, site=given.SITE).scans.first()
    second = refresh(spark, landed, str(tmp_path / "w"), given.AS_OF, site=given.SITE).scans.first()
    assert (first.input, first.files, first.mode) == ("events", 30, "full") and (second.files, second.mode) == (7, "incremental")
    assert 0 < second.bytes < first.bytes and second["rows"] < first["rows"]
    assert spark.read.parquet(str(tmp_path / "w/runs")).count() == 2


def test_marts_are_written_at_the_same_time(spark, small, tmp_path, monkeypatch):
    """The ad spend is being written while the events are staged; the status keeps its order."""
    spending, staging_begun = threading.Event(), threading.Event()
    write, stage = refreshes.versions.write, refreshes.stg_events

    def held(df, path, *rest):
        if path.endswith("fact_ad_spend_google"):
            spending.set()
            assert staging_begun.wait(30)
        return write(df, path, *rest)

    def begun(*args, **options):
        assert spending.wait(30)
        staging_begun.set()
        return stage(*args, **options)

    monkeypatch.setattr(refreshes.versions, "write", held)
    monkeypatch.setattr(refreshes, "stg_events", begun)
    google, meta = given.google_ads_stats(spark, small), given.meta_insights(spark, small)
    outcome = refreshes.refresh(spark, given.raw_events(spark, small), str(tmp_path / "lake"), given.AS_OF, google_stats=google, meta_insights=meta)
    status = outcome.status.collect()
    assert [r["table"] for r in status] == list(refreshes.ORDER) and all(r["ok"] for r in status)
