from datetime import date, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from martlight.operators import quality
from martlight.operators.sinks import append_new, create_if_absent, path_exists, replace_recent, replace_table, with_upload_time
from martlight.plans.refresh import read_mart, refresh, register_views
from martlight.session import shared_folder, size_shuffles
from martlight.sources import schemas
from workload import adapters as given


def days(spark, *values):
    return spark.createDataFrame([(date(2024, 1, d), n) for d, n in values], "date date, n bigint")


def content(spark, path):
    return sorted((r.date.day, r.n) for r in spark.read.parquet(path).select("date", "n").collect())


def test_replace_recent(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(days(spark, (1, 1), (2, 2), (3, 3), (4, 4)), path, "date")
    new = days(spark, (1, 100), (3, 30), (5, 50))
    for _ in range(2):
        replace_recent(new, path, date(2024, 1, 2))
        # Day 1 is before the window, day 2 and 4 have no rows any more, day 5 is new.
        assert content(spark, path) == [(1, 1), (3, 30), (5, 50)]
    replace_recent(days(spark, (9, 9)).limit(0), path, date(2024, 1, 4))
    assert content(spark, path) == [(1, 1), (3, 30)]


def test_empty_tables_and_appends(spark, tmp_path):
    path = str(tmp_path / "spend")
    assert not path_exists(spark, path)
    create_if_absent(spark, path, schemas.FACT_AD_SPEND)
    create_if_absent(spark, path, schemas.FACT_AD_SPEND)
    assert path_exists(spark, path) and spark.read.parquet(path).count() == 0
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    append_new(rows, str(tmp_path / "k"), ("k",))
    append_new(rows.withColumn("k", F.col("k") + 1), str(tmp_path / "k"), ("k",))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "k")).collect())) == [(1, "a"), (2, "b"), (3, "b")]


def test_upload_time_default(spark):
    from datetime import datetime

    now = datetime(2024, 1, 1, 6)
    frame = spark.createDataFrame([(1, None), (2, datetime(2023, 1, 1))], "k int, uploaded_at timestamp")
    assert [r.uploaded_at for r in with_upload_time(frame, now).collect()] == [now, datetime(2023, 1, 1)]


def test_shuffles_follow_the_input():
    session = SimpleNamespace(conf=Settings({"spark.sql.shuffle.partitions": "200"}))
    assert size_shuffles(session, 1 << 30) == 200
    assert size_shuffles(session, 100 << 40) == 819_200


class Settings(dict):
    set = dict.__setitem__


def test_shared_folder():
    cluster = SimpleNamespace(conf=Settings({"spark.checkpoint.dir": "/some/where/"}), sparkContext=SimpleNamespace(master="yarn"))
    assert shared_folder(cluster) == "/some/where"
    unset = SimpleNamespace(conf=Settings(), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        shared_folder(unset)
    local = SimpleNamespace(conf=Settings(), sparkContext=SimpleNamespace(master="local[2]"))
    assert shared_folder(local) == shared_folder(local)


AS_OF = date(2024, 1, 31)
TABLES = ("fact_sessions", "fact_conversions", "funnel_loans", "funnel_registration", "funnel_summary", "dim_channel")


def tables(spark, warehouse):
    return {
        name: sorted(map(str, read_mart(spark, warehouse, name).select(*columns).collect()))
        for name in TABLES
        for columns in [sorted(read_mart(spark, warehouse, name).columns)]
    }


@pytest.fixture(scope="module")
def refreshed(spark, small, tmp_path_factory):
    raw = given.raw_events(spark, small)
    folder = tmp_path_factory.mktemp("refresh")
    whole, stepwise = str(folder / "whole"), str(folder / "stepwise")
    full = refresh(spark, raw, whole, AS_OF, full=True, site=given.SITE)
    early = raw.where(F.col("event_date") < "20240128")
    refresh(spark, early, stepwise, AS_OF - timedelta(days=3), site=given.SITE)
    again = refresh(spark, raw, stepwise, AS_OF, site=given.SITE)
    return whole, stepwise, full, again


def test_incremental_equals_full(spark, refreshed):
    whole, stepwise, full, again = refreshed
    assert tables(spark, whole) == tables(spark, stepwise)
    modes = {r.table: r["mode"] for r in again.status.collect()}
    assert modes["fact_sessions"] == modes["funnel_loans"] == "incremental"
    assert {r["mode"] for r in full.status.collect()} == {"full"}


def test_views(spark, refreshed):
    names = register_views(spark, refreshed[0])
    assert "fact_sessions" in names and "fact_ad_spend" not in names
    total = spark.sql("SELECT sum(sessions) AS s, count(DISTINCT date) AS d FROM fact_sessions JOIN dim_channel USING (source_clean, channel_group)").first()
    fact = read_mart(spark, refreshed[0], "fact_sessions")
    assert (total.s, total.d) == tuple(fact.agg(F.sum("sessions"), F.count_distinct("date")).first()) and total.s > 0


def test_refresh_reports(refreshed):
    _, _, full, _ = refreshed
    failed = {r["check"] for r in full.checks.collect() if not r.passed}
    # Only the row-count warning fails on the small data, so the refresh is good.
    assert failed == {"Row count dropped significantly"} and full.ok and full.input_rows == 1000
    row = full.summary.first()
    related = {(r.table, r["check"]): r.passed for r in full.relations.collect()}
    assert related["fact_sessions", "channels agree with fact_conversions"] and related["fact_sessions", "repeated grain"]
    warnings = sum(not passed for passed in related.values())
    assert (row.failed, row.warnings, row.ok) == (0, 1 + warnings, True)


def test_one_failing_table_does_not_stop_the_others(spark, small, tmp_path):
    broken = given.google_ads_stats(spark, small).withColumn("cost_micros", F.raise_error(F.lit("broken feed")))
    outcome = refresh(spark, given.raw_events(spark, small), str(tmp_path), AS_OF, google_stats=broken, site=given.SITE)
    status = {r.table: r.ok for r in outcome.status.collect()}
    assert not status["fact_ad_spend_google"] and status["funnel_summary"] and not outcome.ok
    assert not [r for r in outcome.checks.collect() if r["check"] == "MART-06 refresh completeness"][0].passed


def test_checks_find_faults(spark):
    bad = spark.createDataFrame([(date(2024, 1, 1), None, -1), (date(2024, 1, 30), 5, 2)], "date date, sessions int, users int")
    got = {r["check"]: r.passed for r in quality.run_checks(bad, quality.refresh_checks(AS_OF)["fact_sessions"]).collect()}
    assert got == {
        "No data for yesterday": True,
        "NULL sessions detected": False,
        "Negative users detected": False,
        "Row count dropped significantly": False,
    }


def test_nothing_measured_is_a_failure(spark):
    empty = spark.createDataFrame([], "date date")
    check = quality.Check("t", "freshness", "critical", quality.days_old(AS_OF), "<=", 7)
    assert not quality.run_checks(empty, [check]).first().passed


def test_checks_that_cannot_run_have_failed(spark):
    checks = quality.refresh_checks(AS_OF)["dim_channel"]
    results = quality.not_run(spark, checks).unionByName(quality.run_checks(spark.createDataFrame([("Paid",)], "channel_type string"), checks))
    assert sorted((r.passed, r.observed) for r in results.collect() if r.passed) == [(True, 0.0)]
    assert quality.summary(results).first().warnings == 1


def test_duplicates_and_orphans(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k int, v string")
    assert tuple(quality.duplicate_keys(frame, ("k", "v")).first()) == (1, 1)
    dimension = spark.createDataFrame([(2,)], "key int")
    assert [tuple(r) for r in quality.orphans(frame, dimension, {"k": "key"}).collect()] == [(1, 2)]
