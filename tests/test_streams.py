import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martlight.operators.sessions import inactivity_sessions
from martlight.plans import facts, staging
from martlight.streaming import jobs, windows
from martlight.streaming import store as stores
from workload import adapters as given
from workload import queries


def test_fact_stream_in_batches_equals_batch(spark, small, tmp_path):
    """Events arrive in several files, the oldest day split over two of them."""
    raw = given.raw_events(spark, small)
    source = str(tmp_path / "in")
    raw.repartition(3).write.parquet(source)
    stream = jobs.event_stream(spark, source, files_per_batch=1)
    fact = str(tmp_path / "fact")
    query = jobs.refresh_session_fact(stream, str(tmp_path / "store"), fact, str(tmp_path / "checkpoint"), given.SITE)
    query.awaitTermination()
    want = facts.fact_sessions(staging.stg_events(raw, given.SITE))
    got = spark.read.parquet(fact).select(*want.columns)
    assert len(query.recentProgress) >= 3
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_final_days_only(spark, small, tmp_path):
    raw = given.raw_events(spark, small)
    raw.write.parquet(str(tmp_path / "in"))
    staged = jobs.staged_stream(jobs.event_stream(spark, str(tmp_path / "in")), given.SITE)
    out = str(tmp_path / "out")
    jobs.write_final(jobs.daily_counts(staged), out, str(tmp_path / "checkpoint")).awaitTermination()
    got = spark.read.parquet(out)
    last = raw.agg(F.timestamp_micros(F.max("event_timestamp"))).first()[0]
    assert (last.date() - got.agg(F.max("date")).first()[0]).days == 8
    assert got.agg(F.sum("events")).first()[0] == raw.where(F.col("event_date") <= got.agg(F.date_format(F.max("date"), "yyyyMMdd")).first()[0]).count()


def arriving(raw, path):
    """One file after another, events up to three days late."""
    arrival = F.floor((F.substring("event_date", 7, 2).cast("int") + F.col("event_timestamp") % 4) / 10)
    for n in range(4):
        raw.where(arrival == n).coalesce(1).write.mode("append").parquet(path)


def test_open_windows_are_replaced_as_events_arrive(spark, small, tmp_path):
    """Every micro-batch changes some windows; the store shows each once, and says which are final."""
    raw = given.raw_events(spark, small)
    arriving(raw, str(tmp_path / "in"))
    staged = jobs.staged_stream(jobs.event_stream(spark, str(tmp_path / "in"), files_per_batch=1), given.SITE)
    store = str(tmp_path / "store")
    windows.write_open(windows.daily_windows(staged), store, str(tmp_path / "checkpoint")).awaitTermination()
    flat = staging.stg_events(raw, given.SITE)
    exact = flat.groupBy(F.col("event_date").alias("date"), "channel_group").agg(
        F.count("*").alias("events"), F.count_if(F.col("event_name") == "page_view").alias("pageviews"), F.count_distinct("user_pseudo_id").alias("users")
    )
    got = windows.daily_counts(spark, store)
    same = got.select("date", "channel_group", "events", "pageviews")
    assert same.exceptAll(exact.drop("users")).count() == 0 and exact.drop("users").exceptAll(same).count() == 0
    last = flat.agg(F.max("event_timestamp")).first()[0]
    assert {r.date for r in got.collect() if r.final} == {r.date for r in got.collect() if (last.date() - r.date).days > 7}
    # sketches of days and channels merge to any span
    users = {r.channel_group: r.approx_users for r in windows.users_of(got, ("channel_group",)).collect()}
    for r in flat.groupBy("channel_group").agg(F.count_distinct("user_pseudo_id").alias("n")).collect():
        assert abs(users[r.channel_group] - r.n) <= 0.03 * r.n + 1


def test_open_sessions_equal_batch(spark, small, tmp_path):
    raw = given.raw_events(spark, small)
    arriving(raw, str(tmp_path / "in"))
    staged = jobs.staged_stream(jobs.event_stream(spark, str(tmp_path / "in"), files_per_batch=1), given.SITE)
    store = str(tmp_path / "store")
    windows.write_open(windows.session_chunks(staged), store, str(tmp_path / "checkpoint")).awaitTermination()
    want = inactivity_sessions(staging.stg_events(raw, given.SITE), "user_pseudo_id", "event_timestamp").select("user_pseudo_id", "session_start", "session_end", "events")
    got = windows.sessions(spark, store)
    assert {True, False} == {r.final for r in got.collect()}
    assert got.drop("final").exceptAll(want).count() == 0 and got.count() == want.count()


def test_compaction_bounds_the_files(spark, tmp_path):
    """Rows of a day over many batches become one folder; a reader sees them once at every step, late rows included."""
    store, schema = str(tmp_path / "store"), "day string, k int, n int"

    def add(batch_id, *rows):
        stores.add_batch(spark.createDataFrame(list(rows), schema), batch_id, store, "day")

    def seen(keys=("day", "k")):
        return sorted((r.day, r.k, r.n) for r in stores.read(spark, store, "day", schema, keys).collect())

    def folders():
        return sorted(str(p.relative_to(tmp_path / "store/open")) for p in (tmp_path / "store/open").glob("day=*/batch=*"))

    assert seen() == []
    for batch in range(4):
        add(batch, ("d1", 1, batch), ("d2", 1, batch), ("d2", batch, 9))
    want = [("d1", 1, 3), ("d2", 0, 9), ("d2", 2, 9), ("d2", 3, 9)]
    assert [r for r in seen() if r[1] != 1 or r[0] == "d1"] == want
    before = seen()
    old = stores.read(spark, store, "day", schema, ("day", "k"))
    # the last batch of a running stream stays out
    assert stores.compact(spark, store, "day", schema, "d2", ("day", "k")) == ["d1"] and seen() == before
    assert sorted((r.day, r.k, r.n) for r in old.collect()) == before and len(folders()) == 8
    add(4, ("d1", 1, 40), ("d1", 7, 7))
    late = [("d1", 1, 40), ("d1", 7, 7)] + [r for r in before if r[0] == "d2"]
    assert seen() == late
    assert stores.compact(spark, store, "day", schema, "d9", ("day", "k"), running=False) == ["d1", "d2"] and seen() == late
    # covered by the compaction before: gone
    assert folders() == [f"day=d1/batch={b}" for b in (3, 4)] + [f"day=d2/batch={b}" for b in range(4)]
    assert stores.compact(spark, store, "day", schema, "d9", ("day", "k"), running=False) == [] and folders() == [] and seen() == late
    # without keys all rows count
    add(5, ("d1", 1, 1), ("d1", 1, 1))
    assert len(seen(())) == len(late) + 2


def test_fact_stream_with_compaction(spark, small, tmp_path):
    raw = given.raw_events(spark, small)
    raw.repartition(2).write.parquet(str(tmp_path / "in"))
    store, fact = str(tmp_path / "store"), str(tmp_path / "fact")
    jobs.refresh_session_fact(jobs.event_stream(spark, str(tmp_path / "in"), files_per_batch=1), store, fact, str(tmp_path / "c"), given.SITE).awaitTermination()
    for _ in range(2):
        jobs.compact_events(spark, store, "99999999", running=False)
    assert not list((tmp_path / "store/open").glob("event_date=*/batch=*"))
    want = facts.fact_sessions(staging.stg_events(raw, given.SITE))
    again = facts.fact_sessions(staging.stg_events(jobs.stored_events(spark, store), given.SITE))
    assert again.exceptAll(want).count() == 0 and want.exceptAll(again).count() == 0


@pytest.mark.parametrize("form", ["file", "folder"])
def test_streams_read_the_given_table_without_a_copy(spark, tmp_path, monkeypatch, form):
    """The stream takes the files of the table as they are, one file or several; only its own results are written."""
    rows = [(n % 40, datetime(2024, 1, 1 + n % 3, n % 24), n % 5, ("click", "view", None)[n % 3], 1.5 * n, f'{{"k": {n}}}') for n in range(60)]
    rows += rows[:7] + [(None, datetime(2024, 1, 2), None, "view", None, None)]
    folder, parts = tmp_path / "in", str(tmp_path / "parts")
    folder.mkdir()
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).repartition(1 if form == "file" else 3).write.parquet(parts)
    if form == "file":
        shutil.copy(next((tmp_path / "parts").glob("part-*")), folder / "events.parquet")
    else:
        shutil.copytree(parts, folder / "events.parquet")
    # A neighbour that is not the table.
    shutil.copytree(parts, folder / "events.parquet2")
    monkeypatch.setattr(queries, "work_path", lambda spark, name: str(tmp_path / "work" / name))
    got = queries.queries()["stream_compacted_store"](spark, str(folder))
    want = facts.fact_sessions(staging.stg_events(given.raw_events(spark, str(folder)), given.SITE))
    assert want.agg(F.sum("pageviews")).first()[0] > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert sorted(p.name for p in (tmp_path / "work").iterdir()) == ["checkpoint", "store", "stream-fact"]
