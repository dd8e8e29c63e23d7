import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of
from workload import oracle as _oracle
from workload import queries as _queries

# One or more of every kind; check.py compares all of them.
SAMPLE = (
    "stg_events stg_events_clean landing_pages stg_bank_applications bank_export_load uploads_tsv dim_date dim_channel "
    "channel_traffic fact_sessions fact_conversions_clean funnel_registration funnel_summary funnel_step_rates fact_ad_spend "
    "bank_merge chart_channel_performance chart_weekly_registration_cohorts chart_total_revenue website_and_bank "
    "kpis_against_targets spend_pacing channel_scorecard campaign_quadrants segment_table contract_by_channel weekly_growth "
    "quality_suite registration_band alert_levels"
).split()


@pytest.fixture(scope="module")
def database(small):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return db


def test_every_query_has_sql():
    assert set(_queries.queries()) == set(_oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_equals_sql(spark, small, database, name):
    frame = entry.queries()[name](spark, small)
    result = database.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == want
    text = frame._jdf.queryExecution().toString()
    assert "Python" not in text and "CartesianProduct" not in text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
