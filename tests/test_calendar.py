from datetime import date, timedelta

from martlight.plans.dims import dim_date


def test_three_years(spark):
    rows = {r["date"]: r for r in dim_date(spark).collect()}
    assert len(rows) == 1095
    assert sum(r["is_holiday"] for r in rows.values()) == 33
    for day, row in rows.items():
        # Sunday-based week: days before the first Sunday are week 0.
        assert row["week_of_year"] == int(day.strftime("%U"))
        assert row["iso_week"] == day.isocalendar()[1]
        assert row["day_of_week"] == (day.isoweekday() % 7) + 1
        assert row["week_start"] == day - timedelta(days=day.weekday())
        assert row["month_start"] == day.replace(day=1)
        assert row["quarter_start"] == date(day.year, 3 * ((day.month - 1) // 3) + 1, 1)
        assert row["is_weekend"] == (day.weekday() >= 5)
        assert row["month_name"] == day.strftime("%B") and row["day_name"] == day.strftime("%A")
