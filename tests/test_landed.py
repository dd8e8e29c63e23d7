"""Landed ad files of drifting types, and bank exports of which some records must not be loaded."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martlight.operators import merge
from martlight.plans import bank
from martlight.sources import readers, schemas
from workload import queries

NOW = datetime(2026, 2, 10, 6)
HEADER = "Event _date,Event Param Value (String),Client_code,LOAN_COUNT,CARD_COUNT,LOAN_AMOUNT,Event Name\n"


def test_every_drop_is_read_with_its_own_types(spark, tmp_path):
    path = str(tmp_path / "in")
    drops = [
        ("a", "date_start date, campaign_name string, adset_name string, impressions bigint, clicks bigint, spend double, reach bigint", [(date(2026, 2, 1), "c", "s", 1, 2, 3.5, 4)]),
        ("b", "date_start string, campaign_name string, impressions string, clicks string, spend string, extra string", [
            ("2026-02-02", "d", " 10 ", "2.0", "1e2", "x"), ("20260203", "e", "N/A", "many", "", "y"), ("never", None, "2.5", None, "-1", "z"),
        ]),
        ("c", "date_start int, campaign_name string, impressions double, clicks int, spend decimal(10,2), reach smallint", [(20260204, "f", 7.0, 8, None, 9)]),
        ("d", "date_start timestamp, impressions double", [(datetime(2026, 2, 5, 3), 7.5)]),
    ]
    for name, schema, rows in drops:
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/drop={name}")
    got = sorted((tuple(r) for r in readers.landed(spark, path, schemas.META_INSIGHTS, lost=True).collect()), key=str)
    assert got == sorted([
        (date(2026, 2, 1), "c", "s", 1, 2, 3.5, 4, []), (date(2026, 2, 2), "d", None, 10, 2, 100.0, None, []),
        (date(2026, 2, 3), "e", None, None, None, None, None, ["clicks"]), (None, None, None, None, None, -1.0, None, ["date_start", "impressions"]),
        (date(2026, 2, 4), "f", None, 7, 8, None, 9, []), (date(2026, 2, 5), None, None, None, None, None, None, ["impressions"]),
    ], key=str)
    lost = {r.field: (r.lost, r["rows"]) for r in readers.lost_values(spark, path, schemas.META_INSIGHTS).collect()}
    assert lost == {"date_start": (1, 6), "campaign_name": (0, 6), "adset_name": (0, 6), "impressions": (2, 6), "clicks": (1, 6), "spend": (0, 6), "reach": (0, 6)}


def test_days_are_pruned_and_only_wanted_columns_read(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [(date(2026, 2, d), "c", "g", d, 1, 10, 1.0, "x") for d in (1, 2, 3)]
    frame = spark.createDataFrame(rows, "data_date date, campaign_name string, ad_group_name string, impressions bigint, clicks bigint, cost_micros bigint, conversions double, extra string")
    frame.write.partitionBy("data_date").parquet(path)
    got = readers.google_ads_stats(spark, path, since=date(2026, 2, 2))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.impressions for r in got.collect()) == [2, 3] and "PartitionFilters: [isnotnull(data_date" in plan and "extra" not in plan
    assert readers.ad_spend(spark, path).count() == 3


def test_refused_records_are_kept_with_their_place(spark, tmp_path):
    folder = tmp_path / "exports"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + '2026-02-01,t1,c1,1,0,10,"two\nlines"\n31/31/2026,t2,c2,1,0,20,x\n2026-02-02,t3,c3,1,0,-5,x\n2026-02-02,t4,c4,1,0,5,x\n')
    (folder / "b.csv").write_bytes((HEADER + "2026-02-03,t5,c5,1,0,30,Кредит\n,,,0,0,0,x\n").encode("cp1251"))
    warehouse = str(tmp_path / "wh")
    with pytest.raises(bank.LoadRefused, match="3 of 6"):
        bank.load_bank(spark, str(folder), warehouse, NOW)
    assert not (tmp_path / "wh/raw").exists()
    got = bank.load_bank(spark, str(folder), warehouse, NOW, max_rejected=0.5)
    assert (got["rejected"], got["added"], got["loans"]) == (3, 3, 3)
    kept = spark.read.schema(bank.REJECTS).parquet(f"{warehouse}/rejects/bank_conversions").where(F.col("loaded_at") == F.lit(NOW)).distinct().collect()
    assert sorted((r.file.rpartition("/")[2], r.record, r.reason, r.event_date_text, r.token_id) for r in kept) == [
        ("a.csv", 2, "unreadable date", "31/31/2026", "t2"), ("a.csv", 3, "negative figure", "2026-02-02", "t3"), ("b.csv", 2, "no key", None, None),
    ]


def test_positions_of_refused_records_go_on_over_files(spark, tmp_path):
    folder = tmp_path / "exports"
    folder.mkdir()
    for name, days in (("part-0", ("2026-02-01", "bad", "2026-02-02")), ("part-1", ()), ("part-2", ("bad", "2026-02-01", "bad"))):
        (folder / name).write_text(HEADER + "".join(f"{d},{name}{n},c,1,0,10,x\n" for n, d in enumerate(days)))
    bank.load_bank(spark, str(folder), str(tmp_path / "wh"), NOW, max_rejected=0.5)
    kept = spark.read.schema(bank.REJECTS).parquet(str(tmp_path / "wh/rejects/bank_conversions")).collect()
    assert sorted((r.position, r.record, r.token_id) for r in kept) == [(2, 2, "part-01"), (4, 1, "part-20"), (6, 3, "part-22")]


def test_damaged_export_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    rows = [(n, n % 7, "F", 1.0 + n, date(2024, 1, 1)) for n in range(400)]
    frame = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date")
    frame.write.parquet(str(tmp_path / "orders.parquet"))
    files = []
    monkeypatch.setattr(queries.bank, "load_bank", lambda spark, path, *a, f=bank.load_bank, **k: files.extend(Path(path).glob("*.csv")) or f(spark, path, *a, **k))
    small = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    for key, value in small.items():
        spark.conf.set(key, value)
    got = queries.queries()["bank_load_rejects"](spark, str(tmp_path)).collect()
    for key in small:
        spark.conf.unset(key)
    known = [n for n in range(400) if n % 10 != 9]
    assert sorted((r.record, r.token_id) for r in got) == [(known.index(n) + 1, f"t{n}") for n in known if n % 40 in (1, 11)]
    assert len(files) > 1


def test_merge_by_buckets_equals_merge_by_days(spark, tmp_path):
    def rows(*values):
        day = [date(2026, 2, 1), date(2026, 2, 2)]
        found = [(t, c, day[d], n, float(n), n, float(n), n, datetime(2026, 2, 1, h)) for t, c, d, n, h in values]
        columns = "token_id string, client_code string, event_date date, loan_count bigint, loan_amount double, deposit_count bigint, deposit_amount double, card_count bigint, uploaded_at timestamp"
        return spark.createDataFrame(found, columns)

    schema = ", ".join(f"{n} {k}" for n, k in rows(("a", "b", 0, 1, 1)).dtypes)
    first = [(f"t{n}", "c", n % 2, n, 1) for n in range(200)]
    late = [("t7", "c", 1, 70, 2), ("t7", "c", 1, 71, 3), ("new", "c", 0, 5, 2), (None, "c", 0, 6, 2)]
    figures = []
    for values in (first, late):
        merge.merge_into(spark, str(tmp_path / "days"), rows(*values), schema)
        figures.append(merge.merge_into_buckets(spark, str(tmp_path / "buckets"), rows(*values), schema, 16))
    by_days, by_buckets = (sorted(map(tuple, spark.read.schema(schema).parquet(str(tmp_path / n)).select(*rows(*late).columns).collect()), key=str) for n in ("days", "buckets"))
    assert by_days == by_buckets and len(by_days) == 202
    assert (figures[1]["added"], figures[1]["updated"]) == (2, 1) and 0 < figures[1]["bytes"] < figures[1]["day_bytes"] / 3
