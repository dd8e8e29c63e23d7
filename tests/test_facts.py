from collections import defaultdict
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martlight.functions.metrics import contract_metrics
from martlight.operators import funnels
from martlight.plans import dims, facts, staging
from workload import adapters as given
from workload.queries import Inputs


@pytest.fixture(scope="module")
def staged(spark, small):
    frame = Inputs(spark, small).staged().cache()
    frame.count()
    return frame


@pytest.fixture(scope="module")
def clean(staged):
    return staging.stg_events_clean(staged, test_users=("u1",), site=given.SITE)


def plan(frame):
    return frame._jdf.queryExecution().toString()


@pytest.mark.parametrize("variant", ["raw", "clean"])
def test_bits_count_like_plain_distincts(staged, clean, variant):
    events = staged if variant == "raw" else clean
    bits, plain = facts.fact_conversions(events, variant), facts.fact_conversions_plain(events, variant)
    plain = plain.select(*bits.columns)
    assert bits.exceptAll(plain).count() == 0 and plain.exceptAll(bits).count() == 0
    assert "Expand" not in plan(bits) and "Expand" in plan(plain)


def test_mapping_as_a_table(spark, staged, clean):
    """A caller's mapping gives the same rows as the built-in list; an unknown event keeps its name."""
    from martlight.sources.literals import event_mapping

    own = staging.stg_events_clean(staged, event_mapping(spark, given.SITE), test_users=("u1",), site=given.SITE)
    assert own.exceptAll(clean).count() == 0 and clean.exceptAll(own).count() == 0
    none = staging.stg_events_clean(staged, event_mapping(spark, given.SITE).limit(0))
    assert none.where("event_name_clean <> event_name OR flow_type <> 'Other' OR is_test_event IS NULL").count() == 0


def test_hot_user_and_hot_key(spark, staged):
    """A third of all rows for one user on one key: same counts, and the hot rows are combined before a shuffle."""
    one = staged.where("user_pseudo_id = 'u7' AND session_id IS NOT NULL").limit(1)
    hot = staged.unionByName(one.crossJoin(spark.range(500)).drop("id"))
    assert {tuple(r) for r in facts.fact_conversions(hot).collect()} == {tuple(r) for r in facts.fact_conversions(staged).collect()}


def test_session_fact_by_brute_force(staged):
    sessions = defaultdict(lambda: [0, 0])
    for r in staged.collect():
        key = (
            r["event_date"], r["source_clean"], r["channel_group"], r["campaign"] or "(not set)", r["device_category"],
            r["product_category"], r["country"], r["city"], "New" if r["session_number"] == 1 else "Returning",
        )
        entry = sessions[key, r["user_pseudo_id"], r["session_id"]]
        entry[0] += r["event_name"] == "page_view"
        entry[1] += r["engagement_time_msec"] or 0
    rows = defaultdict(list)
    for (key, user, _), (views, msec) in sessions.items():
        rows[key].append((user, views, msec))
    want = {}
    for key, members in rows.items():
        users = len({m[0] for m in members} - {None})
        want[key] = (
            users, users if key[-1] == "New" else 0, len(members), sum(v == 1 and m < 10_000 for _, v, m in members),
            sum(v for _, v, _ in members), sum(m for _, _, m in members) / 1000 / len(members),
            sum(v for _, v, _ in members) / len(members),
        )
    got = {tuple(r)[:9]: tuple(r)[9:] for r in facts.fact_sessions(staged).collect()}
    assert got == want


def test_session_fact_needs_no_row_copies(staged):
    assert "Expand" not in plan(facts.fact_sessions(staged))


def test_concatenated_sessions_may_collide(spark):
    rows = [("u1", 11, "page_view"), ("u11", 1, "page_view"), ("u2", None, "page_view")]
    events = spark.createDataFrame(rows, "user_pseudo_id string, session_id bigint, event_name string")
    row = contract_metrics(events.withColumn("session_number", F.lit(1))).first()
    assert (row["users"], row["sessions"], row["user_sessions"], row["session_pairs"], row["pageviews"]) == (3, 2, 1, 2, 3)


def test_counts_of_nothing_are_zero(staged):
    empty = staged.limit(0)
    row = contract_metrics(empty).first()
    assert row["users"] == 0 and row["pageviews"] == 0 and row["pages_per_session"] is None
    assert facts.fact_sessions(empty).count() == 0


def test_funnel_summary_counts_users_once(clean):
    rows = {r["funnel_type"]: r for r in funnels.funnel_summary(clean, date(2024, 1, 31)).collect()}
    population = clean.where(funnels.LOANS.population())
    users = population.where("event_name_clean = 'sprint_apply_click'").agg(F.count_distinct("user_pseudo_id")).first()[0]
    assert rows["Loans"]["loans_apply"] == users and rows["Loans"]["reg_apply"] is None
    done = population.where("event_name_clean = 'sprint_check_limit_completed' AND NOT is_test_event")
    assert rows["Loans"]["loans_completed"] == done.select("user_pseudo_id").dropna().distinct().count()
    assert rows["Registration"]["loans_apply"] is None


def test_channel_pairs_from_sources_equal_those_from_events(spark, small, staged):
    raw = given.raw_events(spark, small)
    fast = dims.dim_channel(dims.channel_pairs(raw, given.SITE)).collect()
    slow = dims.dim_channel(staged).collect()
    assert sorted(fast) == sorted(slow)


def test_parameters(spark):
    schema = "event_params array<struct<key: string, value: struct<string_value: string, int_value: bigint>>>"
    rows = [([("a", ("x", None)), ("b", (None, 7))],), ([],), (None,), ([("b", (None, 1)), ("b", (None, 2))],)]
    frame = spark.createDataFrame(rows, schema)
    from martlight.functions.columns import event_param

    got = frame.select(event_param("a", "string_value"), event_param("b", "int_value")).collect()
    assert [tuple(r) for r in got] == [("x", 7), (None, None), (None, None), (None, 1)]
    with pytest.raises(PySparkException, match="occurs twice"):
        frame.select(event_param("b", "int_value", strict=True)).collect()


def test_scan_reads_only_needed_fields(spark, small, tmp_path):
    path = str(tmp_path / "raw")
    given.raw_events(spark, small).write.partitionBy("event_date").parquet(path)
    from martlight.sources import readers

    raw = readers.events(spark, path, since=date(2024, 1, 24))
    fact = staging.stg_events(raw, given.SITE).groupBy("event_date").agg(F.sum("session_id"))
    text = plan(fact)
    assert "PartitionFilters: [isnotnull(event_date" in text and ">= 20240124" in text
    read = text[text.rindex("ReadSchema") :]
    assert "int_value" in read and "string_value" not in read and "traffic_source" not in read


@pytest.mark.parametrize("variant", ["raw", "clean"])
def test_both_facts_of_one_pass(spark, small, variant):
    staged = staging.stg_events_clean(staging.stg_events(given.raw_events(spark, small), given.SITE), test_users=("u1",), site=given.SITE)
    sessions, conversions = facts.both_facts(staged, variant)
    for got, want in ((sessions, facts.fact_sessions(staged)), (conversions, facts.fact_conversions(staged, variant))):
        assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert "events.parquet" not in sessions._jdf.queryExecution().toString() + conversions._jdf.queryExecution().toString()
