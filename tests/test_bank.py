from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martlight.operators import merge
from martlight.plans import bank
from martlight.sources import schemas

HEADER = "Event _date,Event Param Value (String),Client_code,LOAN_COUNT,LOAN_AMOUNT,CARD_COUNT,Event Name\n"
ROWS = "2026-02-01,t1,c1,1,100.5,0,Кредит\n2/14/2026,t2,c2,1.9,abc,,x\n,nan,c3,bad,,2,\n"
NOW = datetime(2026, 2, 15, 6, 0)


def write(tmp_path, data: bytes) -> str:
    path = tmp_path / "export.csv"
    path.write_bytes(data)
    return str(path)


@pytest.mark.parametrize("encoding", ["utf-8", "cp1251"])
def test_encodings_and_cleaning(spark, tmp_path, encoding):
    frame = bank.read_export(spark, write(tmp_path, (HEADER + ROWS).encode(encoding)))
    got = bank.clean_export(bank.check_headers(frame), NOW).collect()
    picked = [(r.event_date, r.token_id, r.client_code, r.loan_count, r.loan_amount, r.card_count, r.event_name) for r in got]
    assert picked == [
        (date(2026, 2, 1), "t1", "c1", 1, 100.5, 0, "Кредит"),
        (date(2026, 2, 14), "t2", "c2", 1, 0.0, 0, "x"),
        (None, None, "c3", 0, 0.0, 2, None),
    ]
    assert got[0].deposit_count == 0 and got[0].acquired_source is None and got[0].uploaded_at == NOW


def test_latin1_when_the_cyrillic_code_page_lacks_a_byte(spark, tmp_path):
    frame = bank.read_export(spark, write(tmp_path, HEADER.encode() + b"2026-02-01,t1,c1,1,1,0,caf\xe9\x98\n"))
    assert frame.first()["Event Name"] == "caf\xe9\x98"


def test_quoted_line_breaks(spark, tmp_path):
    frame = bank.read_export(spark, write(tmp_path, (HEADER + '2026-02-01,t1,c1,1,1,0,"two\nlines"\n').encode()))
    assert [r["Event Name"] for r in frame.collect()] == ["two\nlines"]


def test_missing_headers_and_bad_dates(spark, tmp_path):
    frame = bank.read_export(spark, write(tmp_path, b"Event _date,Client_code\nsoon,c1\n"))
    with pytest.raises(ValueError, match="LOAN_COUNT.*CARD_COUNT"):
        bank.check_headers(frame)
    row = bank.export_checks(frame).first()
    assert (row.total_rows, row.missing_columns, row.bad_dates, row.empty_tokens) == (1, 2, 1, 1)
    with pytest.raises(PySparkException, match="not a date"):
        bank.clean_export(frame, NOW).collect()


def rows(spark, *values):
    frame = spark.createDataFrame(
        [(t, c, d, n, float(n), u) for t, c, d, n, u in values],
        "token_id string, client_code string, event_date date, loan_count bigint, loan_amount double, uploaded_at timestamp",
    )
    zero = {"deposit_count": 0, "deposit_amount": 0.0, "card_count": 0}
    for name, value in zero.items():
        frame = frame.withColumn(name, F.lit(value).cast("double" if "amount" in name else "bigint"))
    return frame.withColumn("acquired_source", F.concat(F.lit("s"), "loan_count"))


D1, D2 = date(2026, 2, 1), date(2026, 2, 2)
OLD, NEW, NEWER = datetime(2026, 2, 3), datetime(2026, 2, 4), datetime(2026, 2, 5)


def test_upsert(spark):
    target = rows(spark, ("t1", "c1", D1, 1, OLD), ("t1", "c1", D1, 2, OLD), ("t2", "c2", D1, 3, OLD), (None, "c3", D1, 4, OLD))
    source = rows(
        spark, ("t1", "c1", D1, 10, NEW), ("t1", "c1", D1, 11, NEWER), ("t2", "c2", D2, 12, NEW), (None, "c3", D1, 13, NEW)
    )
    got = {(r.token_id, r.client_code, r.event_date, r.loan_count, r.acquired_source, r._action) for r in merge.upsert(target, source).collect()}
    assert got == {
        ("t1", "c1", D1, 11, "s1", "update"),
        ("t1", "c1", D1, 11, "s2", "update"),
        ("t2", "c2", D1, 3, "s3", "keep"),
        (None, "c3", D1, 4, "s4", "keep"),
        ("t2", "c2", D2, 12, "s12", "insert"),
        (None, "c3", D1, 13, "s13", "insert"),
    }


def test_merge_twice_is_merge_once(spark, small, tmp_path):
    from workload import adapters as given

    base = given.bank_rows(spark, small)
    source = given.merge_source(base).where(F.col("token_id").isNotNull())
    path = str(tmp_path / "bank")
    merge.merge_into(spark, path, given.merge_target(base), schemas.BANK_CONVERSIONS)
    first = merge.merge_into(spark, path, source, schemas.BANK_CONVERSIONS)
    once = sorted(map(str, spark.read.schema(schemas.BANK_CONVERSIONS).parquet(path).collect()))
    second = merge.merge_into(spark, path, source, schemas.BANK_CONVERSIONS)
    twice = sorted(map(str, spark.read.schema(schemas.BANK_CONVERSIONS).parquet(path).collect()))
    assert first["added"] > 0 and first["updated"] > 0
    assert second == {"added": 0, "updated": first["added"] + first["updated"]} and once == twice


def test_load_bank(spark, tmp_path):
    path = write(tmp_path, (HEADER + "2026-02-01,t1,c1,1,100.5,0,x\n2026-02-01,nan,c2,1,5,0,x\n").encode())
    first = bank.load_bank(spark, path, str(tmp_path / "wh"), NOW)
    assert (first["added"], first["updated"], first["loans"], first["total_revenue"]) == (2, 0, 1, 101.0)
    second = bank.load_bank(spark, path, str(tmp_path / "wh"), NOW)
    # The row without a token never matches, so it is added again; it does not reach staging.
    assert (second["added"], second["updated"], second["loans"]) == (1, 1, 1)
