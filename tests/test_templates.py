"""The CSV templates users fill in."""

from datetime import date

import pytest

from martlight.sources import readers, schemas


def write(tmp_path, text):
    path = tmp_path / "t.csv"
    path.write_text(text)
    return str(path)


def test_targets(spark, tmp_path):
    path = write(tmp_path, "period,metric,channel,product,target_value,notes\n2026-02-01,roas,meta_ads,all,3.0,Target\n")
    row = readers.monthly_targets(spark, path).first()
    assert (row.period, row.metric, row.target_value, row.notes) == (date(2026, 2, 1), "roas", 3.0, "Target")


def test_empty_daily_budget_is_spread_over_the_month(spark, tmp_path):
    path = write(tmp_path, "period,channel,monthly_budget_usd,daily_budget_usd,notes\n2026-02-01,sms,1400,,x\n2026-03-01,sms,10,9,\n")
    rows = readers.monthly_budgets(spark, path).collect()
    assert [r.daily_budget_usd for r in rows] == [50.0, 9.0]


def test_local_spend_is_optional(spark, tmp_path):
    text = "date,channel,campaign,impressions,clicks,spend_usd\n2026-02-01,google_ads,c,10,1,2.5\n"
    row = readers.manual_ad_spend(spark, write(tmp_path, text)).first()
    assert (row.spend_amd, row.adset, row.clicks) == (1000.0, None, 1)


def test_approvals(spark, tmp_path):
    text = "application_id,status,apply_date,approval_date,revenue_amd\nA1,approved,2026-02-01,2026-02-04,125000\nA2,pending,2026-02-01,,0\n"
    rows = readers.approvals(spark, write(tmp_path, text)).collect()
    assert [(r.application_id, r.approval_date, r.user_id) for r in rows] == [("A1", date(2026, 2, 4), None), ("A2", None, None)]


def test_uploads(spark, tmp_path):
    frame = spark.range(5).selectExpr("CAST(id AS INT) AS k", "concat('v', id) AS v")
    frame.write.parquet(str(tmp_path / "p"))
    frame.write.option("header", True).option("sep", "\t").csv(str(tmp_path / "t"))
    assert readers.upload(spark, str(tmp_path / "t"), "tsv", "k int, v string").count() == 5
    assert readers.upload(spark, str(tmp_path / "p"), "parquet", "k int, v string").count() == 5
    with pytest.raises(ValueError):
        readers.upload(spark, "x", "xlsx", "k int")


def test_literal_schemas_parse(spark):
    for name in dir(schemas):
        if name.isupper():
            assert spark.createDataFrame([], getattr(schemas, name)).columns
