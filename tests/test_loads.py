"""Loads of files that differ from each other, and merges and reports over rows without a key."""

from datetime import date, datetime

import pytest

from martlight.operators import merge
from martlight.plans import analytics, bank
from martlight.sources import readers, schemas

HEADER = "Event _date,Event Param Value (String),Client_code,LOAN_COUNT,CARD_COUNT,LOAN_AMOUNT,Event Name\n"
NOW = datetime(2026, 2, 10, 6)


def test_encodings_of_single_files(spark, tmp_path):
    folder = tmp_path / "exports"
    folder.mkdir()
    (folder / "a b.csv").write_bytes((HEADER + "2026-02-01,t1,c1,1,0,10,Кредит\n").encode())
    (folder / "b.csv").write_bytes((HEADER + '2/2/2026 10:30:00,t2,c2,1,0,20,"Кредит\nи карта"\n').encode("cp1251"))
    (folder / "c.csv").write_bytes((HEADER + "03.02.2026,t3,c3,1,0,30,plain\n").encode())
    rows = {r.token_id: r for r in bank.clean_export(bank.read_export(spark, str(folder)), NOW).collect()}
    assert {t: r.event_name for t, r in rows.items()} == {"t1": "Кредит", "t2": "Кредит\nи карта", "t3": "plain"}
    assert [rows[t].event_date for t in ("t1", "t2", "t3")] == [date(2026, 2, d) for d in (1, 2, 3)]
    assert bank.export_checks(bank.read_export(spark, str(folder))).first()["bad_dates"] == 0


def test_loads_replace_only_their_days(spark, tmp_path):
    def load(name, text):
        (tmp_path / name).write_text(HEADER + text)
        return bank.load_bank(spark, str(tmp_path / name), str(tmp_path / "wh"), NOW)

    load("one.csv", "2026-02-01,t1,c1,1,0,10,x\n2026-02-02,t2,c2,1,0,20,x\n")
    first = sorted(p.name for p in (tmp_path / "wh/marts/fact_bank_conversions/date=2026-02-01").glob("*.parquet"))
    totals = load("two.csv", "2026-02-02,t2,c2,2,0,25,x\n2026-02-03,t3,c3,1,0,30,x\n")
    assert (totals["added"], totals["updated"], totals["loans"], totals["total_revenue"]) == (1, 1, 4, 65)
    assert first == sorted(p.name for p in (tmp_path / "wh/marts/fact_bank_conversions/date=2026-02-01").glob("*.parquet"))


def test_templates_with_line_breaks_and_torn_records(spark, tmp_path):
    text = 'application_id,status,apply_date,notes\nA1,approved,2026-02-01,"two\nlines, ""quoted"""\nA2,pending,2026-02-02,\n'
    (tmp_path / "good.csv").write_text(text)
    rows = readers.typed_csv(spark, str(tmp_path / "good.csv"), "application_id string, apply_date date, notes string").collect()
    assert [(r.application_id, r.notes) for r in rows] == [("A1", 'two\nlines, "quoted"'), ("A2", None)]
    (tmp_path / "torn.csv").write_text("application_id,status,apply_date\nA1,approved,2026-02-01,more,fields\n")
    with pytest.raises(Exception, match="MALFORMED|CSV"):
        readers.approvals(spark, str(tmp_path / "torn.csv")).collect()


def test_merge_reads_each_side_once(spark, tmp_path):
    columns = "token_id string, client_code string, event_date date, loan_count bigint, uploaded_at timestamp"
    day = date(2026, 2, 1)
    spark.createDataFrame([("t1", "c", day, 1, NOW), (None, "c", day, 2, NOW)], columns).write.parquet(str(tmp_path / "old"))
    new = [("t1", "c", day, 5, NOW), ("t1", "c", day, 4, datetime(2026, 1, 1)), (None, "c", day, 3, NOW), (None, "c", day, 3, NOW), ("t2", "c", day, 6, NOW)]
    spark.createDataFrame(new, columns).write.parquet(str(tmp_path / "new"))
    merged = merge.upsert(spark.read.parquet(str(tmp_path / "old")), spark.read.parquet(str(tmp_path / "new")), updated=("loan_count", "uploaded_at"))
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    got = sorted((r.token_id or "", r.loan_count, r["_action"]) for r in merged.collect())
    assert got == [("", 2, "keep"), ("", 3, "insert"), ("", 3, "insert"), ("t1", 5, "update"), ("t2", 6, "insert")]


def test_spend_without_applications_and_targets_of_channel_and_product(spark):
    day = date(2026, 2, 1)
    apps = spark.createDataFrame(
        [(day, "google_ads", "loan", "approved", 100.0), (day, "google_ads", "card", "approved", 50.0)],
        "apply_date date, apply_channel string, product_type string, status string, revenue_amd double",
    )
    spent = spark.createDataFrame([(day, "Meta Ads", 7.0)], "date date, channel_group string, spend_usd double")
    codes = spark.createDataFrame([("meta_ads", "Meta Ads")], "channel_code string, channel_group string")
    kpis = analytics.month_kpis(apps, spent, codes, 400.0)
    rows = {(r.channel, r["product"], r.metric): r.actual for r in kpis.collect()}
    assert rows["google_ads", "loan", "revenue"] == 100 and rows["all", "all", "revenue"] == 150
    assert ("meta_ads", "all", "revenue") in rows and rows["meta_ads", "all", "revenue"] is None


def test_segments_without_a_name(spark):
    day = date(2026, 2, 1)
    web = "date date, device_category string, user_type string, city string, sessions bigint, users bigint, bounced_sessions bigint"
    sessions = spark.createDataFrame([(day, None, "New", None, 4, 4, 1), (day, "mobile", "New", "Other", 4, 4, 3)], web)
    conversions = spark.createDataFrame([(None, None, 2), ("mobile", "Other", 1), ("tv", "Other", 3)], "device_category string, city string, registrations bigint")
    rows = {(r.segment, r.name): r for r in analytics.segment_table(sessions, conversions).collect()}
    assert rows["device", "(not set)"].registrations == 2 and rows["city", "(not set)"].registrations == 2
    assert rows["device", "tv"].registrations == 3 and rows["device", "tv"].sessions is None
    assert rows["city", "Other"].registrations == 4 and rows["device", "mobile"].bounce_vs_avg == 25.0


def test_bank_schema_is_kept(spark, tmp_path):
    (tmp_path / "one.csv").write_text(HEADER + "2026-02-01,t1,c1,1,0,10,x\n")
    bank.load_bank(spark, str(tmp_path / "one.csv"), str(tmp_path / "wh"), NOW)
    stored = spark.read.schema(schemas.BANK_CONVERSIONS).parquet(str(tmp_path / "wh/raw/bank_conversions"))
    assert stored.first().token_id == "t1"
