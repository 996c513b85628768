from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bazaarmill.operators.calendar import YEAR_2024, calendar, calendar_for, next_date, numbered_open_days


@pytest.fixture(scope="module")
def cal(spark):
    return calendar(spark, "2024-01-01", "2024-12-31").toPandas()


def test_year_totals(cal):
    got = (len(cal), cal.is_open.sum(), (~cal.is_open).sum(), (cal.day_name == "Sunday").sum(), cal.is_weekend.sum(), cal.is_peak.sum(), cal.is_sale.sum())
    assert got == (366, 306, 60, 52, 104, 179, 63)


def test_month_totals(cal):
    by = cal.groupby("month")[["is_open", "is_peak", "is_sale"]].sum()
    assert by.is_open.tolist() == [24, 25, 25, 25, 27, 25, 27, 27, 25, 27, 26, 23]
    assert by.is_peak.tolist() == [20, 5, 7, 16, 7, 6, 17, 31, 26, 7, 6, 31]
    assert by.is_sale.tolist() == [0, 21, 0, 0, 0, 21, 0, 0, 0, 0, 21, 0]


def test_closed_days_that_are_no_sundays(cal):
    closed = cal[~cal.is_open & (cal.day_name != "Sunday")].date_key.tolist()
    assert closed == [20240101, 20240102, 20240103, 20240329, 20240401, 20241225, 20241226, 20241227]


def test_due_days(cal):
    day = cal.date_key % 100
    assert cal[cal.is_open & (day == 1)].month.tolist() == [2, 3, 5, 6, 7, 8, 10, 11]
    assert cal[cal.is_open & (day == 25)].month.tolist() == [1, 3, 4, 5, 6, 7, 9, 10, 11]


def test_weeks_start_on_sunday(spark):
    c = calendar(spark, "2023-01-01", "2024-12-31").toPandas().set_index("date_key")
    assert c.loc[20230101, "week_of_year"] == 1 and c.loc[20230108, "week_of_year"] == 2
    assert c.loc[20240106, "week_of_year"] == 1 and c.loc[20240107, "week_of_year"] == 2
    assert c.loc[20241231, "week_of_year"] == 53


def test_dates_centuries_apart(spark):
    df = spark.createDataFrame([(dt.date(1700, 1, 1),), (dt.date(2024, 2, 1),)], "d date")
    cal = calendar_for(df, "d", YEAR_2024)
    assert cal.count() == (dt.date(2024, 12, 31) - dt.date(1700, 1, 1)).days + 1
    got = [r.next_date for r in next_date(df, "d", cal.withColumn("is_open", F.col("full_date") == F.lit("2024-02-05").cast("date")), name="next_date").orderBy("d").collect()]
    assert got == [dt.date(2024, 2, 5)] * 2


def test_calendar_covers_full_years_of_the_data(spark):
    df = spark.createDataFrame([(dt.date(2023, 5, 3),), (dt.date(2024, 2, 1),)], "d date")
    got = calendar_for(df, "d", YEAR_2024).agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert tuple(got) == (20230101, 20241231, 731)


def test_next_date_and_its_limit(spark):
    cal = calendar(spark, "2024-01-01", "2024-12-31")
    days = ["2024-01-01", "2024-01-07", "2024-03-29", "2024-12-25", "2024-12-31", "2025-01-01"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    got = {str(r.d): r.n and str(r.n) for r in next_date(df, "d", cal, name="n").collect()}
    assert got == {
        "2024-01-01": "2024-01-04", "2024-01-07": "2024-01-08", "2024-03-29": "2024-03-30", "2024-12-25": "2024-12-28",
        "2024-12-31": "2024-12-31", "2025-01-01": None,
    }
    limited = next_date(df, "d", cal, name="n", upper=F.lit("2024-12-27").cast("date")).filter("n IS NOT NULL").count()
    assert limited == 3


def test_open_days_are_numbered_from_zero(spark):
    r = numbered_open_days(calendar(spark, "2024-01-01", "2024-12-31"), ["month"]).filter("month = 1").toPandas()
    assert sorted(r.day_index) == list(range(24)) and set(r.day_count) == {24}
